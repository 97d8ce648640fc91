"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of consecutive words with smallest period q and a length of at
least max(6, 4 q) that no neighbouring word extends. A run of period 2^k <= q < 2^(k+1)
holds a block of 2^k words that starts at a multiple of twice that, and the same
block q words on. So for each k, every such block asks for its occurrences in the
window of starts from 2^k to 2^(k+1) words after its own:

* blocks of 2^k words are ranked by doubling, which leaves a suffix array in which
  the places of a block are an interval;
* a wavelet tree over that array gives the least place at or past a bound within an
  interval (range successor), so the first two occurrences of a window cost two queries;
* occurrences of a block in a window of its own length are an arithmetic progression.
  One or two of them are candidate periods themselves. Three or more mean that the
  block has their difference d as period; the q-run then carries the ends of the
  d-stretch around the block to those around the occurrences, which leaves at most two
  candidates, whatever the number of occurrences;
* ranks of blocks also tell how far two places agree in either direction, which gives
  a candidate's whole extent, exactly.

Equal stretches found with several periods keep the least: that is their smallest.

Words of several texts are ranked together, at least CHUNK of them or one text, with
the text as part of the word; memory is about 150 bytes a word of the chunk or of the
longest text. Texts of other rows, tasks or orders change nothing.

Defined results: null and texts without words have no runs and an empty collapsed
text; repeated rows repeat; very long texts are read whole; runs come in order of
start, then period. Columns of the caller named like an added one give way; an empty
table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import without

#: Words that are ranked together.
CHUNK = 1 << 16
LEAST_WORDS, LEAST_PERIODS = 6, 4
WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Ranks:
    """Ranks of all blocks of 2^k items for k = 0, 1, …, and the suffixes in order of the last level.

    A level is (rank of the block at each place, places in the order where a rank begins);
    equal ranks are equal blocks. Levels end where all blocks differ, or at `levels`.
    """

    def __init__(self, items: np.ndarray, levels: int):
        n = self.n = len(items)
        order = np.argsort(items, kind="stable")
        new = np.r_[True, np.diff(items[order]) != 0]
        self.levels = []
        while True:
            heads = np.flatnonzero(new)
            sizes = np.diff(heads, append=n)
            rank = np.empty(n, np.int64)
            rank[order] = np.repeat(heads, sizes)
            self.levels.append((rank, heads))
            if len(heads) == n or len(self.levels) >= levels:
                break
            at = np.flatnonzero(np.repeat(sizes > 1, sizes))
            open_ = order[at]
            after = open_ + (1 << (len(self.levels) - 1))
            second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
            key = rank[open_] * (n + 1) + second + 1
            o = np.argsort(key)
            order[at] = open_[o]
            new[at[1:]] |= np.diff(key[o]) != 0
        self.order = order

    def interval(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the blocks of 2^k items at some places stand in the order."""
        rank, heads = self.levels[k]
        left = rank[at]
        return left, np.append(heads, self.n)[np.searchsorted(heads, left) + 1]

    def agree(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """How many items agree from i and j (i < j) on, or before them."""
        out = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.levels))):
            rank, w = self.levels[k][0], 1 << k
            while len(out):
                a, b = (i - out - w, j - out - w) if back else (i + out, j + out)
                same = (a >= 0) & (b < self.n)
                same &= rank[np.maximum(a, 0)] == rank[np.minimum(b, self.n - 1)]
                out += same * w
                if k < len(self.levels) - 1 or not same.any():
                    break
        return out


class WaveletTree:
    """Range successor over a permutation of 0 … n-1, for many ranges at a time."""

    def __init__(self, values: np.ndarray):
        self.n, self.bits = len(values), max(1, int(len(values)).bit_length())
        self.zeros = []
        v = values
        for bit in reversed(range(self.bits)):
            one = (v >> bit & 1).astype(bool)
            self.zeros.append(np.r_[0, np.cumsum(~one)])
            v = np.concatenate([v[~one], v[one]])

    def _below(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each range are less than the bound."""
        out = np.zeros(len(left), np.int64)
        for bit, zeros in zip(reversed(range(self.bits)), self.zeros):
            a, b = zeros[left], zeros[right]
            up = (bound >> bit & 1).astype(bool)
            out += np.where(up, b - a, 0)
            left, right = np.where(up, zeros[-1] + left - a, a), np.where(up, zeros[-1] + right - b, b)
        return out

    def _nth(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of each range that has so many lesser ones in it."""
        out = np.zeros(len(left), np.int64)
        for bit, zeros in zip(reversed(range(self.bits)), self.zeros):
            a, b = zeros[left], zeros[right]
            up = rank >= b - a
            rank = rank - np.where(up, b - a, 0)
            out |= up.astype(np.int64) << bit
            left, right = np.where(up, zeros[-1] + left - a, a), np.where(up, zeros[-1] + right - b, b)
        return out

    def successor(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The least value of each range [left, right) that is not below the bound; n if there is none."""
        bound = np.minimum(bound, self.n)
        below = self._below(left, right, bound)
        out = np.full(len(left), self.n)
        some = below < right - left
        out[some] = self._nth(left[some], right[some], below[some])
        return out


def _candidates(ranks: Ranks, tree: WaveletTree, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of blocks of 2^k items that may be in a run of a period from 2^k to 2^(k+1) - 1."""
    m = 1 << k
    p = np.arange(0, ranks.n, 4 if k < 2 else 2 * m)
    left, right = ranks.interval(k, p)
    some = right - left > 1
    p, left, right = p[some], left[some], right[some]
    first = tree.successor(left, right, p + m)
    some = first < np.minimum(p + 2 * m, ranks.n)
    p, left, right, first = p[some], left[some], right[some], first[some]
    second = tree.successor(left, right, first + 1)
    d, last = second - first, np.minimum(p + 2 * m, ranks.n)
    two = second < last
    third = np.where(two, second + d, last)
    three = third < last
    three[three] = ranks.levels[k][0][third[three]] == ranks.levels[k][0][p[three]]
    at, period = [p[~three], p[two & ~three]], [(first - p)[~three], (second - p)[two & ~three]]
    p, first, d = p[three], first[three], d[three]
    for back in (True, False):
        shift = first - p + (ranks.agree(p, p + d, True) - ranks.agree(first, first + d, True) if back else ranks.agree(first, first + d) - ranks.agree(p, p + d))
        good = (shift >= m) & (shift < 2 * m)
        at.append(p[good])
        period.append(shift[good])
    return np.concatenate(at), np.concatenate(period)


def runs(items: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, period) of all runs of the items, by start, then period.

    Stretches longer than `longest` are not there: the caller parts texts by items of their own.
    """
    levels = max(1, (longest // LEAST_PERIODS).bit_length())
    if longest < LEAST_WORDS:
        return np.empty((0, 3), np.int64)
    ranks = Ranks(items, levels)
    tree = WaveletTree(ranks.order)
    found = []
    for k in range(len(ranks.levels)):
        at, q = _candidates(ranks, tree, k)
        before, after = ranks.agree(at, at + q, True), ranks.agree(at, at + q)
        length = before + after + q
        good = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
        found.append(np.stack([at - before, length, q], 1)[good])
    out = np.unique(np.concatenate(found), axis=0)
    return out[np.r_[True, (np.diff(out[:, :2], axis=0) != 0).any(1)][: len(out)]]


def planted(n: int, key: int | None) -> np.ndarray:
    """The original word that stands at each of n places, after the edit that makes one text of ten periodic.

    With h = crc32 of the key in decimals and g = h // 10: where h % 10 is 0, the places
    from a = g % n on repeat p = 1 + (n - a) // (3 + g % 8) original words. No key, no edit.
    """
    out = np.arange(n)
    h = zlib.crc32(str(key).encode())
    if key is None or n == 0 or h % 10:
        return out
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    out[a:] = a + np.arange(n - a) % p
    return out


def _chunk(texts: list[list[str]]) -> list[np.ndarray]:
    """The runs of each text of words."""
    ids: dict[str, int] = {}
    sizes = np.array([len(t) for t in texts])
    words = np.fromiter((ids.setdefault(w, len(ids)) for t in texts for w in t), np.int64, int(sizes.sum()))
    # each text's words and then an item that nothing equals; a text's words equal those of no other
    starts = np.r_[0, np.cumsum(sizes + 1)]
    text = np.repeat(np.arange(len(texts)), sizes + 1)
    items = np.full(starts[-1], len(ids), np.int64)
    inside = np.ones(starts[-1], bool)
    inside[starts[1:] - 1] = False
    items[inside] = words
    found = runs(items + text * (len(ids) + 1), int(sizes.max(initial=0)))
    cuts = np.searchsorted(found[:, 0], starts)
    return [found[cuts[i] : cuts[i + 1]] - (starts[i], 0, 0) for i in range(len(texts))]


def _collapsed(words: list[str], found: np.ndarray) -> str:
    """The words that no run holds after its first period, joined by spaces."""
    if len(found):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, found[:, 0] + found[:, 2], 1)
        np.add.at(edge, found[:, 0] + found[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]
    return " ".join(words)


RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
FOUND = ["n_words", "runs", "collapsed"]


def _detect(batches: Iterator[pa.RecordBatch], names: list[str], planting: bool) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def whole(part: pa.RecordBatch, texts: list[list[str]]) -> pa.RecordBatch:
        found = _chunk(texts)
        rows = np.concatenate(found)
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(f) for f in found])], pa.int32()), pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in range(3)], fields=list(kind)))
        counts = pa.array([len(t) for t in texts], pa.int64())
        return pa.RecordBatch.from_arrays([*part.columns[:-2], counts, lists, pa.array(map(_collapsed, texts, found), pa.string(), size=len(texts))], names)

    for b in batches:
        keys, column = b.column(b.num_columns - 2), b.column(b.num_columns - 1)
        first, held, texts = 0, 0, []
        for i in range(b.num_rows):
            words = WORD.findall(column[i].as_py() or "")
            if planting:
                words = list(map(words.__getitem__, planted(len(words), keys[i].as_py()).tolist()))
            texts.append(words)
            held += len(words)
            if held >= CHUNK or i == b.num_rows - 1:
                yield whole(b.slice(first, i + 1 - first), texts)
                first, held, texts = i + 1, 0, []


def detect(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, plant_by: str | None = None) -> DataFrame:
    """The kept columns (all but the text if None), n_words, runs and the collapsed text.

    runs is an array of (start, length, period) in words; the collapsed text has each run's
    first period only. plant_by, a column of integers, makes texts periodic before
    (`planted`), for tests at any size. Columns with these names give way.
    """
    held = [F.col(f"`{c}`") for c in keep] if keep is not None else without(docs, text_col, *FOUND)
    key = F.col(f"`{plant_by}`").cast("long") if plant_by else F.lit(None).cast("long")
    rows = docs.select(*held, key.alias("_key"), F.col(f"`{text_col}`").alias("_text"))
    new = [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]
    kind = T.StructType([*rows.schema.fields[:-2], *new])
    return rows.mapInArrow(partial(_detect, names=kind.names, planting=plant_by is not None), kind)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant_by: str | None = None) -> DataFrame:
    """Per row: id, n_runs, the run of the greatest exponent, and the digests of all runs and of the collapsed text."""
    found = detect(docs, text_col, [id_col], plant_by)
    # runs are in order of start, then period: of equal exponents the first stays
    best = F.expr("aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (a, x) -> case when a is null or x.length * a.period > a.length * x.period then x else a end)")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    out = found.withColumn("_best", best)
    values = [F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")]
    exponent = F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli")
    return out.select(F.col(f"`{id_col}`"), F.size("runs").cast("long").alias("n_runs"), *values, exponent, F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
