"""Importance resampling towards a target distribution of hashed words.

Features are all runs of one to `longest` consecutive words; each falls into one of
`buckets` by the crc32 of its UTF-8 bytes. A bucket's gain is a thousandth log ratio of
its smoothed shares in the target's and the documents' features; a document's weight is
the sum of its features' gains, looked up in one array. Weight and Gumbel noise
of the document's id make its score; the highest scores are drawn, which is sampling
without replacement in proportion to the weights.

The cutoff is found by weighted medians of medians. Every block of undecided rows that
a task reads gives its median key, a task the median of those weighted by block sizes, and
the driver that of the tasks' (one row a task) weighted by what each has left. At least an
eighth of the undecided keys lie on either side of such a pivot. The same pass that counts
how many keys are above the last pivot has the medians of both sides ready, so a round
is one pass; what is undecided is written anew when it has shrunk to a quarter, so
all passes together read a small multiple of the scores. The winners alone are sorted.

Words are runs of ASCII letters and digits and of all other than ASCII characters, after
lower-casing A-Z only.

Defined results: null and empty texts have no features and weigh 0; they count as
documents of no words. Ties go to the smaller id, a null id last; rows equal in score and
id are told apart by weight and number of features, and if all of these are equal it does
not matter which is drawn. Ids are integers. Repeated rows are
documents of their own; very long texts are read whole. An empty target gives gains from
the documents alone; no documents give an empty table. Kept columns named like an added
one give way.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import forget, stored

#: On UTF-8 bytes, of which only A-Z have been lower-cased.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Distinct features whose buckets a task remembers.
KNOWN = 1 << 18
#: Undecided rows of which a block has so many at most, and that are few enough to be sorted in one place.
BLOCK = 10_000
#: An id after all others.
LAST = (1 << 63) - 1


class Features:
    """Buckets of a text's features, by a bounded memory of those met before."""

    def __init__(self, buckets: int, longest: int):
        self.buckets, self.longest, self.known = buckets, longest, {}

    def bucket(self, feature: bytes) -> int:
        if len(self.known) >= KNOWN:
            self.known.clear()
        out = self.known[feature] = zlib.crc32(feature) % self.buckets
        return out

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All features' buckets, and of each text the number of features and of words."""
        known, find, out, sizes, words = self.known, WORD.findall, [], [], []
        for text in texts:
            own = find(text.encode().lower()) if text else []
            words.append(len(own))
            every = own if self.longest == 1 else [b" ".join(own[i : i + k]) for k in range(1, self.longest + 1) for i in range(len(own) - k + 1)]
            sizes.append(len(every))
            out += [known[f] if f in known else self.bucket(f) for f in every]
        return np.array(out, np.int64), np.array(sizes, np.int64), np.array(words, np.int64)


def _parts(column: pa.Array, rows: int = 1000) -> Iterator[tuple[int, list]]:
    for a in range(0, len(column), rows):
        yield a, column.slice(a, rows).to_pylist()


def _count(batches: Iterator[pa.RecordBatch], buckets: int, longest: int) -> Iterator[pa.RecordBatch]:
    features, counts = Features(buckets, longest), np.zeros(buckets, np.int64)
    for b in batches:
        for _, texts in _parts(b.column(0)):
            counts += np.bincount(features.of(texts)[0], minlength=buckets)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "n"])


def feature_counts(docs: DataFrame, text_col: str = "text", buckets: int = 10_000, longest: int = 1) -> np.ndarray:
    """How many features of all texts fall into each bucket: one row a bucket and task is shuffled, `buckets` rows reach the driver."""
    found = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(partial(_count, buckets=buckets, longest=longest), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r.bucket] = r.n
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: the log of its smoothed share in the target over that in the documents, in thousandths, rounded down."""
    s_all, t_all, n = int(documents.sum()), int(target.sum()), len(documents)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for s, t in zip(documents.tolist(), target.tolist())], np.int64)


def _weigh(batches: Iterator[pa.RecordBatch], gained: bytes, longest: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    gain = np.frombuffer(gained, np.int64)
    features = Features(len(gain), longest)
    for b in batches:
        for a, texts in _parts(b.column(b.num_columns - 1)):
            at, sizes, words = features.of(texts)
            total = np.r_[0, np.cumsum(gain[at])]
            ends = np.cumsum(sizes)
            new = [sizes, words, total[ends] - total[ends - sizes]]
            yield pa.RecordBatch.from_arrays([*(c.slice(a, len(texts)) for c in b.columns[:-1]), *map(pa.array, new)], names)


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise of an id, in thousandths, rounded down: the same in every run."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


OWN = ("n_features", "n_words", "weight", "score", "rank")


def scored(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, buckets: int = 10_000, longest: int = 1, seed: int = 2024) -> DataFrame:
    """The kept columns (id first), n_features, n_words, weight and score of every document."""
    gain = gains(feature_counts(docs, text_col, buckets, longest), feature_counts(target, text_col, buckets, longest))
    kept = [c for c in keep or [id_col] if c.lower() not in OWN]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    kind = T.StructType([*rows.schema.fields[:-1], *[T.StructField(n, T.LongType()) for n in ("n_features", "n_words", "weight")]])
    out = rows.mapInArrow(partial(_weigh, gained=gain.tobytes(), longest=longest, names=kind.names), kind)
    return out.withColumn("score", F.col("weight") + noise(F.col("_id"), seed))


# ---- the exact cutoff ------------------------------------------------------------------


def weighted_median(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of keys (rows of equal length, the greater the better), the one that half of the weight is not better than."""
    order = np.lexsort(keys.T[::-1])
    total = np.cumsum(weights[order])
    return keys[order[np.searchsorted(total * 2, total[-1])]]


def _medians(batches: Iterator[pa.RecordBatch], pivot: tuple[int, int] | None) -> Iterator[pa.RecordBatch]:
    """One row a task and side of the pivot (1 above it, 0 equal, -1 below): how many keys, and the median of the blocks' medians."""
    found: dict[int, list[tuple[np.ndarray, int]]] = {}
    for b in batches:
        for a in range(0, b.num_rows, BLOCK):
            keys = np.stack([b.column(c).slice(a, BLOCK).to_numpy(zero_copy_only=False) for c in range(2)], 1)
            side = np.zeros(len(keys), np.int64) + 1
            if pivot:
                s, i = keys[:, 0], keys[:, 1]
                side = np.where(s != pivot[0], np.sign(s - pivot[0]), np.where(i > pivot[1], 1, np.where(i < pivot[1], -1, 0)))
            for k in np.unique(side).tolist():
                own = keys[side == k]
                found.setdefault(k, []).append((weighted_median(own, np.ones(len(own), np.int64)), len(own)))
    if found:
        rows = [(k, sum(n for _, n in own), *weighted_median(np.array([m for m, _ in own]), np.array([n for _, n in own])).tolist()) for k, own in found.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["side", "n", "score", "id"])


def cutoff(keys: DataFrame, n: int, most: int = BLOCK) -> tuple[int, int] | None:
    """The n-th greatest of the keys (score, id), both long and not null; None if there are fewer.

    Each round is one pass over the undecided keys; `most` of them or fewer are sorted in one place.
    """
    spark, held, written = keys.sparkSession, keys, None
    low = high = pivot = undecided = None
    while True:
        rows = held.where(_within(low, high))
        found = rows.mapInArrow(partial(_medians, pivot=pivot), "side long, n long, score long, id long").collect()
        if pivot is None:
            undecided = found
            last = sum(r.n for r in found)
            if not 1 <= n <= last:
                return None
        else:
            above, equal = (sum(r.n for r in found if r.side == k) for k in (1, 0))
            if above < n <= above + equal:
                break
            if n <= above:
                low, undecided = pivot, [r for r in found if r.side == 1]
            else:
                high, undecided, n = pivot, [r for r in found if r.side == -1], n - above - equal
        size = sum(r.n for r in undecided)
        if size <= most:
            few = sorted(held.where(_within(low, high)).select("score", "id").collect(), reverse=True)
            pivot = tuple(few[n - 1])
            break
        if last >= 4 * size:
            before, held, last = written, stored(held.where(_within(low, high)), "undecided"), size
            written = held
            if before is not None:
                forget(spark, before)
        pivot = tuple(weighted_median(np.array([(r.score, r.id) for r in undecided]), np.array([r.n for r in undecided])).tolist())
    if written is not None:
        forget(spark, written)
    return pivot


def _within(low: tuple[int, int] | None, high: tuple[int, int] | None) -> Column:
    """Whether a key is greater than low and less than high."""
    s, i, out = F.col("score"), F.col("id"), F.lit(True)
    if low is not None:
        out = out & ((s > low[0]) | ((s == low[0]) & (i > low[1])))
    if high is not None:
        out = out & ((s < high[0]) | ((s == high[0]) & (i < high[1])))
    return out


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, buckets: int = 10_000, longest: int = 1, seed: int = 2024) -> DataFrame:
    """scored(), and rank: 1, 2, 3 … by score, ties to the smaller id, of the `percent` of the
    documents of at least `least_words` words that are drawn (rounded down); null of the rest."""
    rows = stored(scored(docs, target, id_col, text_col, keep, buckets, longest, seed), "scored")
    # the greatest key is the best: of equal scores the smallest id, a null one last
    key = F.coalesce(-F.col("_id"), F.lit(-LAST))
    able = F.col("n_words") >= least_words
    keys = rows.where(able).select("score", key.alias("id"))
    n = rows.where(able).count() * percent // 100
    cut = cutoff(keys, n)
    shown = [c for c in rows.columns if c not in ("_id", "n_words")]
    if cut is None:
        return rows.select(*shown, F.lit(None).cast("long").alias("rank"))
    good = able & ((F.col("score") > cut[0]) | ((F.col("score") == cut[0]) & (key >= cut[1])))
    # sorted once and written, so that a row's place is the same for all that read it
    order = [F.col("score").desc(), key.desc(), F.col("weight").desc(), F.col("n_features").desc()]
    winners = stored(rows.where(good).orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "winners")
    part = F.shiftright("_at", 33)
    counts = sorted(winners.groupBy(part.alias("part")).count().collect())  # a row a task
    before = np.cumsum([0, *(c["count"] for c in counts)]).tolist()
    offsets = winners.sparkSession.createDataFrame([(int(c.part), b) for c, b in zip(counts, before)], "_part int, _before long")
    ranked = winners.join(F.broadcast(offsets), part.cast("int") == F.col("_part"))
    ranked = ranked.withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
    return rows.where(~good).select(*shown, F.lit(None).cast("long").alias("rank")).union(ranked.select(*shown, F.col("rank").cast("long")))
