"""Which rows of a large target a small batch can touch: a Bloom filter of the batch's keys.

The filter is a table of 64-bit words, one for about four keys; a key's hash names its
word and four bits in it. Joined to the target by a broadcast of at most MOST_KEYS / 4
rows, it parts the target, where it stands, into rows that may have a key of the batch
and rows that can't; only the former need an exchange. It lets about one in
a hundred of other rows pass, and never holds back one that matches. Batches of more keys
have no filter: then the whole target is joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.functions.canonical import quoted

MOST_KEYS, KEYS_A_WORD, BITS = 4_000_000, 4, 4


@dataclass(frozen=True)
class KeyFilter:
    """words: _word, _bits; n_words tells a key's word from its hash."""

    keys: tuple[str, ...]
    types: tuple[str, ...]
    words: DataFrame
    n_words: int

    def part(self, target: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of target that may have a key of the batch, and those that have none."""
        word, bits = _place(self.keys, self.types, self.n_words)
        rows = target.withColumns({"_w": word, "_b": bits}).join(F.broadcast(self.words), F.col("_w") == F.col("_word"), "left")
        hit = F.coalesce(F.col("_bits").bitwiseAND(F.col("_b")) == F.col("_b"), F.lit(False))
        names = [F.col(quoted(c)) for c in target.columns]
        return rows.where(hit).select(*names), rows.where(~hit).select(*names)


def _place(keys: Sequence[str], types: Sequence[str], n_words: int) -> tuple[Column, Column]:
    """A key's word, from the upper bits of its hash, and its bits, from the lower 24."""
    h = F.xxhash64(*[F.col(quoted(k)).cast(t) for k, t in zip(keys, types)])
    return F.pmod(F.shiftrightunsigned(h, 24), F.lit(n_words)), _bits(h)


def _bits(h: Column) -> Column:
    out = F.lit(0).cast("long")
    for i in range(BITS):
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")))
    return out


def key_filter(batch: DataFrame, keys: Sequence[str], n: int | None = None, target: DataFrame | None = None, most: int = MOST_KEYS) -> KeyFilter | None:
    """A filter of the batch's keys; None for more than `most` of them. n: the rows, if known; else they are counted.

    Keys are compared as the target's types if it is given.
    """
    rows = batch.select(*[F.col(quoted(k)) for k in keys])
    n = rows.count() if n is None else n
    if n > most or not keys:
        return None
    types = tuple((target or batch).schema[k].dataType.simpleString() for k in keys)
    n_words = max(1, n // KEYS_A_WORD)
    word, bits = _place(keys, types, n_words)
    words = rows.select(word.alias("_word"), bits.alias("_bits")).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    return KeyFilter(tuple(keys), types, words, n_words)
