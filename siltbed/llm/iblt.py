"""Document fingerprints by invertible Bloom lookup sketches of paragraph digests.

A text is cut into pieces: at line ends and after punctuation, and a stretch of
over 400 characters without either after words whose digest says so; an edit
moves the cuts near it only. The digests of its pieces (64 bits, told apart when a piece repeats) go into the cells of a sketch:
each digest into three cells, which count, exclusive-or the digests and
exclusive-or a check word. Two sketches of one size subtract cell by cell; cells
that hold a single digest are peeled until none is left, which gives the digests
that only one text has. When peeling stalls, both sketches are built again at
three times the size. The fingerprint is the sketch of the least size, as text. Sketches of many documents lie in one array, so that all
of a batch are filled, subtracted and peeled together.

Likeness is the share of pieces, of those that either text has, that both have.

Neighbours in the order of ids are found without moving a text twice: the rows
go to ranges of ids once; the first row of each range goes to the range before
as well. An id that very many rows share, null among them, is cut into ranges by the
digests of its texts.

Defined results: null and empty texts have no pieces, and are like one another
(likeness 1); ids descend, null last, rows that share an id follow the digest of
their text; of a table of one row the next document is itself; very long texts are
read whole; an empty table gives an empty table. Ids must be integers (TypeError
else). Ties: rows of one id and one text are equal, so their order shows nowhere.
Columns of the caller may have any name: the result has its own only.
"""

import base64
import math
import re
import zlib
from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

LEAST_CELLS, HASHES = 24, 3
LONG_PIECE = 400
#: In long stretches, a word ends a piece with chance 1 in this.
PIECE_WORDS = 8
#: What ends a piece.
PIECE = re.compile(r"[^\n.,;:!?\u3002\uff01\uff1f]+[.,;:!?\u3002\uff01\uff1f]*|[.,;:!?\u3002\uff01\uff1f]+")
BATCH_ROWS = 256


def pieces(text: str | None) -> list[str]:
    """The pieces of a text, without the white space between them."""
    out = []
    for p in PIECE.findall(text or ""):
        if len(p) <= LONG_PIECE:
            if p := p.strip():
                out.append(p)
            continue
        now = []
        for w in p.split():
            now.append(w)
            if zlib.crc32(w.encode("utf-8", "surrogatepass")) % PIECE_WORDS == 0:
                out.append(" ".join(now))
                now = []
        if now:
            out.append(" ".join(now))
    return out


def digests(text: str | None) -> np.ndarray:
    """A digest of each piece; the n-th copy of a piece has a digest of its own."""
    h = np.array([xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass")) for p in pieces(text)], np.uint64)
    order = np.argsort(h, kind="stable")
    new = np.r_[True, h[order][1:] != h[order][:-1]][: len(h)]
    if not new.all():
        nth = np.arange(len(h)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        again = nth > 0
        h[order[again]] = mix(h[order[again]] ^ mix(nth[again].astype(np.uint64)))
    return h


def mix(x: np.ndarray) -> np.ndarray:
    """A further hash of hashes."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Sketches:
    """Sketches of many owners: counts, digests and checks of their cells.

    An owner's cells are HASHES equal parts; a digest has a cell in each.
    """

    def __init__(self, owners: int, cells: int):
        self.owners, self.cells = owners, cells
        self.count = np.zeros(owners * cells, np.int64)
        self.keys, self.checks = np.zeros(owners * cells, np.uint64), np.zeros(owners * cells, np.uint64)

    def add(self, keys: np.ndarray, owner: np.ndarray, sign: np.ndarray | None = None) -> "Sketches":
        check, x, part = mix(mix(keys)), keys, self.cells // HASHES
        for i in range(HASHES):
            x = mix(x + np.uint64(i + 1))
            at = owner * self.cells + i * part + (x % np.uint64(part)).astype(np.int64)
            self.count += np.bincount(at, sign, len(self.count)).astype(np.int64)
            np.bitwise_xor.at(self.keys, at, keys)
            np.bitwise_xor.at(self.checks, at, check)
        return self

    def minus(self, other: "Sketches") -> "Sketches":
        out = Sketches(self.owners, self.cells)
        out.count, out.keys, out.checks = self.count - other.count, self.keys ^ other.keys, self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(keys, owners, signs) of the digests of one side only, and whether each owner failed. Empties the sketches."""
        found = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
        while True:
            pure = np.flatnonzero(np.abs(self.count) == 1)
            pure = pure[mix(mix(self.keys[pure])) == self.checks[pure]]
            if not len(pure):
                break
            keys, owner, sign = self.keys[pure], pure // self.cells, self.count[pure]
            order = np.lexsort((keys, owner))
            first = np.r_[True, (keys[order][1:] != keys[order][:-1]) | (owner[order][1:] != owner[order][:-1])]
            pick = order[first]
            found.append((keys[pick], owner[pick], sign[pick]))
            self.add(keys[pick], owner[pick], -sign[pick])
        left = (self.count != 0) | (self.keys != 0)
        keys, owner, sign = (np.concatenate(x) for x in zip(*found))
        return keys, owner, sign, left.reshape(self.owners, self.cells).any(axis=1)

    def texts(self) -> list[str]:
        parts = [self.count.astype("<i4"), self.keys.astype("<u8"), (self.checks & np.uint64(0xFFFF)).astype("<u2")]
        rows = zip(*(x.reshape(self.owners, self.cells) for x in parts))
        return [base64.b64encode(b"".join(x.tobytes() for x in row)).decode() for row in rows]


def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of many owners end to end, and whose they are."""
    return np.concatenate([np.empty(0, np.uint64), *sets]), np.repeat(np.arange(len(sets)), [len(x) for x in sets])


def differences(a: list[np.ndarray], b: list[np.ndarray], cells: int = LEAST_CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, pair, sign): the digests that only a (1) or only b (-1) of each pair has.

    All pairs are tried at the least size, those that fail at three times it, and so on.
    """
    out = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
    todo = np.arange(len(a))
    while len(todo):
        # too many for this size for certain: the counts alone say so
        early = np.array([abs(len(a[k]) - len(b[k])) > cells for k in todo])
        tried = todo[~early]
        mine, theirs = flat([a[k] for k in tried]), flat([b[k] for k in tried])
        keys, owner, sign, failed = Sketches(len(tried), cells).add(*mine).minus(Sketches(len(tried), cells).add(*theirs)).peel()
        good = ~failed[owner]
        out.append((keys[good], tried[owner[good]], sign[good]))
        todo = np.sort(np.r_[todo[early], tried[failed]])
        cells *= 3
    return tuple(np.concatenate(x) for x in zip(*out))


def likenesses(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Of each pair: common digests by all digests; 1 if there are none."""
    _, pair, sign = differences(a, b)
    mine = np.bincount(pair[sign > 0], minlength=len(a))
    both = np.array([len(x) for x in a], np.int64) - mine
    every = np.array([len(x) for x in b], np.int64) + mine
    return np.where(every > 0, both / np.maximum(every, 1), 1.0)


def fingerprints(sets: list[np.ndarray]) -> list[str]:
    return Sketches(len(sets), LEAST_CELLS).add(*flat(sets)).texts()


def fingerprint(text: str | None) -> str:
    return fingerprints([digests(text)])[0]


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pairs(batches: Iterator[pa.RecordBatch], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows (range, guest, id, text), sorted; a guest is the first row of the next range."""

    def result(held: list[tuple]) -> pa.RecordBatch:
        ids, texts, keys, following, next_keys = map(list, zip(*held))
        new = [edited(t, n) for t, n in zip(texts, following)]
        new_keys = [digests(t) for t in new]
        columns = [ids, [len(t) for t in texts], [sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new], fingerprints(keys), fingerprints(new_keys), likenesses(keys, new_keys), likenesses(keys, next_keys)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    before, held = None, []  # range, id, text, digests
    for batch in batches:
        for k in range(0, batch.num_rows, BATCH_ROWS):
            for r, guest, i, t in zip(*(c.to_pylist() for c in batch.slice(k, BATCH_ROWS).columns)):
                t = t or ""
                keys = digests(t)
                if before is not None and before[0] == r:
                    held.append((*before[1:], t, keys))
                before = None if guest else (r, i, t, keys)
            if held:
                yield result(held)
                held = []


#: The greatest id.
LAST = (1 << 63) - 1


class Ranges:
    """Ranges of rows in descending order of ids, nulls last: about as many rows in each.

    Intervals of ids begin at `starts`; an id with more rows than a range is to have (null
    is one) is an interval of its own, which the digests of its texts cut into slices.
    """

    def __init__(self, rows: DataFrame, parts: int):
        seen = rows.agg(F.percentile_approx("id", [k / parts for k in range(1, parts)] or [0.5], 10 * parts), F.count("*"), F.count("id")).first()
        cuts, n, known = seen[0] or [], seen[1], seen[2]
        heavy = {c: k for c in set(cuts) if (k := cuts.count(c)) > 1}
        self.starts = sorted({*cuts, *(c + 1 for c in heavy if c < LAST)})
        #: slices of each interval in ascending order, the one below all starts first; of null
        self.slices = [1, *(heavy.get(c, 1) for c in self.starts)]
        self.nulls = max(1, -(-(n - known) * parts // max(n, 1)))
        descending = [*self.slices[::-1], self.nulls]
        self.total = sum(descending)
        first = np.cumsum([0, *descending])
        self.first, self.first_null = first[:-2][::-1].tolist(), int(first[-2])
        self.heavy, self.n_null = sorted(heavy), n - known

    def interval(self) -> Column:
        """Which interval an id is in: starts that are not above it, looked up in blocks of a square root of them."""
        if not self.starts:
            return F.lit(0)
        size = max(1, math.isqrt(len(self.starts)))
        nested = [self.starts[k : k + size] for k in range(0, len(self.starts), size)]
        heads, blocks = F.lit([b[0] for b in nested]), F.array(*[F.lit(b) for b in nested])
        block = F.size(F.filter(heads, lambda c: c <= F.col("id")))
        inside = F.size(F.filter(F.element_at(blocks, F.greatest(block, F.lit(1))), lambda c: c <= F.col("id")))
        return (F.greatest(block - 1, F.lit(0)) * size + inside).cast("int")

    def range_of(self, digest: Column) -> Column:
        """The range of a row; a digest is asked for only where it decides."""
        # slices follow the digests in their order as signed numbers
        share = (digest.cast("double") + 2.0**63) / 2.0**64
        at = F.col("_interval") + 1
        n = F.when(F.col("id").isNull(), F.lit(self.nulls)).otherwise(F.element_at(F.lit(self.slices), at))
        first = F.when(F.col("id").isNull(), F.lit(self.first_null)).otherwise(F.element_at(F.lit(self.first), at))
        return (first + F.when(n > 1, F.least(F.floor(share * n), n - 1)).otherwise(0)).cast("int")


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Per row: id, n_chars, edited_sha256, both fingerprints, near_edited, near_next."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer column")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_chars", T.LongType()), *[T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")], *[T.StructField(n, T.DoubleType()) for n in ("near_edited", "near_next")]])
    kinds = [to_arrow_type(docs.schema[id_col].dataType), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    cut = Ranges(rows, parts)
    digest = F.xxhash64("text")
    placed = rows.withColumn("_interval", cut.interval())
    # the first row of each range is its guest in the one before: the greatest id, from ids alone, and
    # where an id has ranges of its own, the least digest of each
    single = rows.where(F.col("id").isNotNull() & ~F.col("id").isin(cut.heavy)).select("id").withColumn("_interval", cut.interval())
    firsts = [(r.range, r.id, None) for r in single.select(cut.range_of(F.lit(0)).alias("range"), "id").groupBy("range").agg(F.max("id").alias("id")).collect()]
    if cut.heavy or cut.n_null:
        shared = placed.where(F.col("id").isNull() | F.col("id").isin(cut.heavy)).select(cut.range_of(digest).alias("range"), "id", digest.alias("h"))
        firsts += [(r.range, r.id, r.h) for r in shared.groupBy("range", "id").agg(F.min("h").alias("h")).collect()]
    if not firsts:
        return spark.createDataFrame([], kind)
    order = sorted(firsts, key=lambda r: r[0])  # a row a range
    host = {r[0]: order[k - 1][0] for k, r in enumerate(order)}  # the first range's guest goes to the last
    guests = spark.createDataFrame([(i, h, host[r]) for r, i, h in order], "gid long, gh long, range int")
    own = placed.select(cut.range_of(digest).alias("range"), F.lit(False).alias("guest"), "id", digest.alias("h"), "text")
    wanted = rows.where(F.col("id").isNull() | F.col("id").isin([i for _, i, _ in order if i is not None])) if len(order) <= 10_000 else rows
    sent = wanted.withColumn("h", digest).join(F.broadcast(guests), F.col("id").eqNullSafe(F.col("gid")) & (F.col("gh").isNull() | (F.col("h") == F.col("gh"))))
    sent = sent.groupBy("range").agg(F.min(F.struct("h", "id", "text")).alias("row")).select("range", F.lit(True).alias("guest"), "row.id", "row.h", "row.text")
    both = own.union(sent).repartitionById(cut.total, F.col("range")).sortWithinPartitions("range", "guest", F.col("id").desc_nulls_last(), "h")
    return both.select("range", "guest", F.col("id").cast(docs.schema[id_col].dataType), "text").mapInArrow(partial(_pairs, names=kind.names, kinds=kinds), kind)
