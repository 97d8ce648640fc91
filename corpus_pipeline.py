"""From raw documents to token ids: filter, deduplicate, redact, mix, encode.

Each stage works on all rows that the one before it kept. All but the last
return the columns of documents.

Defined results, as the operators state them: null and empty texts are scored, are copies of each
other, hold no personal data, have size 0 and no ids; rows of a null id come last; repeated rows are
copies, of which one stays; equal texts keep the least id; texts are taken whole however long;
columns of any name that documents have pass through all stages but the last; empty tables give
empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltbed.llm import bpe, mixing, pii, simhash, toxicity
from siltbed.llm.common import forget, last_kept, stored, table
from siltbed.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field fitted to the labels rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near copies stays: four fifths of their words in common shingles of five."""
    return simhash.drop_near_duplicates(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each identifier, disguised ones included, gives way to its kind in brackets."""
    return pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeat or shrink to their targets: a row for each time a document is taken."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    return bpe.round_trip(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("source_mixing", mix_sources),
    ("bpe_encode_decode", encode),
]

#: Neither the fitted field nor the vocabulary's merges can be said in SQL; tests hold
#: the pipeline against a version that works in one place.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with last_kept(spark):
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            forget(spark, before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
