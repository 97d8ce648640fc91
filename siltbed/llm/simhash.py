"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are computed where the rows lie. Rows with equal fingerprints
collapse to one entry before any comparison. Two fingerprints within the radius
agree on some m - radius of m bit blocks (pigeonhole), so every such choice of
blocks keys a bucket; nothing within the radius is lost. In a bucket the entries
are sorted by population count and compared tile by tile with exclusive-or and
bit counts, skipping tile pairs whose counts differ beyond the radius. Buckets
above `tile` entries are cut by population count, and where need be by a salt,
into pieces whose pairs are units of work of their own; an entry goes to as many
units as its bucket has pieces, so the filter takes larger ones. A unit gives the spanning links of what
it finds, not all pairs.

Filtering (`drop_near_duplicates`) is to catch copies of similarity 0.8 and more
on word shingles, which differ in far more than four of 64 bits. Similarity there
is the share of both texts' words that stand in shingles of five words that the other text
has, too: for a passage in common that is the passage's share of the texts, and a word changed
here and there costs its own place, not the five shingles that it stands in. Besides, the
cosine of the sets of distinct shingles has to be LIKE or more. Words are runs of letters,
digits and underscores, case ignored, so a lost comma changes no shingle. A document
has a SimHash of 256 bits, and KEYS keys, each of two minima of hashed shingles, take the
place of the bit blocks: copies that share the part j of their shingles share a key with
chance 1 - (1 - j^2)^24, over 0.99 at a cosine of LIKE (j is 0.43) and 0.9998 at 0.7. The
comparison within buckets is the same, but gives candidates only. Candidates that
hang together meet a second time with their shingle hashes, cut
into units of bounded size like buckets, and two of them link if they are alike,
counted exactly. Texts without words are copies of each other.
Most keys belong to one text only: keys are dealt out with 8 bytes of the text's digest, and only
entries that share theirs get fingerprints and are compared. Texts move only where a Bloom
filter (operators/touched.py, up to four million keys; beyond, all are joined) says that they may
be a candidate's, or that their row may be one that goes or is repeated; exact joins follow.
SimHash and keys are of distinct shingles, so lines that repeat do not
count. Of 256 bits, copies of cosine 0.6 differ in 76 on average (deviation about
7.3); the radius is 96.

Defined results: null and empty texts have the fingerprint 0 and link like any
other; repeated rows keep their own rows; rows whose id is null join components
but never name them; an empty table gives an empty table; very long texts are
hashed whole. Ties: of a group's rows with the least id, the one with the least
digest of its text stays; a bit set in exactly half of the hashes is 0. Columns of
the caller may have any name: near_duplicates returns its own three only, and
drop_near_duplicates works under names of its own and gives all columns back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import forget, last_kept, looked_up, stored
from siltbed.llm.components import components
from siltbed.operators.touched import key_filter

#: Fixed values of the fingerprint: A-Z to a-z, XXH64's seed, words a shingle.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SEED, SHINGLE = 42, 4
LOOSE = re.compile(r"\w+")
BITS = 64
SLICE_CHARS = 1 << 20


def shingle_hashes(text: str | None, width: int, loose: bool = False) -> np.ndarray:
    """XXH64 of each shingle, repeats included; of the whole sequence if it is shorter.

    loose: words are runs of letters, digits and underscores, without regard to case.
    """
    if loose:
        words = [w.encode("utf-8", "surrogatepass") for w in LOOSE.findall((text or "").lower())]
    else:
        words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.empty(0, "<u8")
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, SEED)], "<u8")
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - width]]
    return np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[width - 1 :])], "<u8")


def majority(h: np.ndarray) -> int:
    """Bits set in over half of the hashes, as a signed integer."""
    total = np.zeros(BITS, np.int64)
    for k in range(0, len(h), 1 << 15):
        total += np.unpackbits(h[k : k + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(total * 2 > len(h), bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text, as a signed integer."""
    return majority(shingle_hashes(text, width))


#: Odd multipliers, by rule: they make further hashes of a hash.
ODD = np.random.default_rng(42).integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
WIDE_WORDS, WIDE_KEYS, WIDE_RADIUS = 4, 24, 96
#: Share of words in common shingles from which texts are copies, and the cosine of their sets that they have at least.
COPIES, LIKE = 0.8, 0.6
#: Members of sets in a unit that checks candidates, about.
SET_TILE = 1 << 20


def wide_fingerprint(text: str | None, width: int) -> tuple[list[int], list[int]]:
    """Of the distinct shingles: a SimHash of WIDE_WORDS 64-bit words, WIDE_KEYS keys of two minima each."""
    h = np.unique(shingle_hashes(text, width, True))
    if not len(h):
        return [0] * WIDE_WORDS, [0] * WIDE_KEYS
    mixed = [h * m for m in ODD[: WIDE_WORDS - 1]]
    words = [majority(h), *(majority(x ^ (x >> np.uint64(29))) for x in mixed)]
    least = np.array([(h * m).min() for m in ODD[8 : 8 + 2 * WIDE_KEYS]])
    keys = (least[0::2] * ODD[4]) ^ (least[1::2] >> np.uint64(7))
    return words, keys.view(np.int64).tolist()


def _fingerprints(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = pa.array((fingerprint(x, width) for x in b.column(2).to_pylist()), pa.int64(), size=b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fps], ["id", "h", "fp"])


def _digest(text_col: str) -> Column:
    """128 bits that tell texts apart; null is not the empty text."""
    return F.coalesce(F.md5(F.col(f"`{text_col}`").cast("binary")), F.lit(""))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(id, h, fp) for each row; h tells texts apart."""
    kind = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("h", T.StringType()), T.StructField("fp", T.LongType())])
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), _digest(text_col).alias("h"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(partial(_fingerprints, width=width), kind)


def block_masks(blocks: int, radius: int) -> list[int]:
    """Signed 64-bit masks, one for each choice of blocks - radius of the blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(parts, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def blocks_for(n: int, radius: int) -> int:
    """The fewest blocks whose buckets hold 256 of n evenly spread fingerprints at most."""
    blocks = radius + 1
    while blocks < radius + 4 and n >> (BITS * (blocks - radius) // blocks) > 256:
        blocks += 1
    return blocks


def covered(own: np.ndarray, other: np.ndarray, width: int) -> int:
    """How many words of a text, given by its shingles in order, stand in shingles that another has."""
    at = np.flatnonzero(np.isin(own, other))
    return int(np.minimum(np.diff(at), width).sum()) + width if len(at) else 0


def alike(a: np.ndarray, b: np.ndarray, least: float, width: int, sets: tuple[np.ndarray, np.ndarray] | None = None) -> bool:
    """Whether the cosine of two texts' sets of shingles is LIKE or more, and the share of both texts' words
    in common shingles `least`. a and b are their shingles in order, `sets` the sorted distinct ones, if
    the caller has them. Two empty texts are alike."""
    if not len(a) or not len(b):
        return len(a) == len(b)
    x, y = sets or (np.unique(a), np.unique(b))
    # the cosine first: a merge of two sorted sets turns most pairs away
    low, high = sorted((len(x), len(y)))
    bound = LIKE * LIKE * high * (1 - 1e-12)
    if low < bound:
        return False
    both = np.sort(np.concatenate([x, y]), kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    if common * common < bound * low:
        return False
    n, m = len(a) + width - 1, len(b) + width - 1
    return covered(a, b, width) + covered(b, a, width) >= least * (n + m) * (1 - 1e-12)


#: Pairs of a tile from which their common shingles are counted all at once; columns of a matrix then.
TOGETHER, COLUMNS = 8192, 4096


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many members each left set shares with each right one: products of 0/1 matrices over what both sides have."""
    sides = [(np.concatenate(x), np.repeat(np.arange(len(x)), [len(y) for y in x]), len(x)) for x in (left, right)]
    known = np.intersect1d(sides[0][0], sides[1][0])
    out = np.zeros((len(left), len(right)), np.float32)
    for k in range(0, len(known), COLUMNS):
        part, both = known[k : k + COLUMNS], []
        for members, owner, n in sides:
            at = np.minimum(np.searchsorted(part, members), len(part) - 1)
            hit = part[at] == members
            own = np.zeros((n, len(part)), np.float32)
            own[owner[hit], at[hit]] = 1
            both.append(own)
        out += both[0] @ both[1].T
    return out


def spanning_links(words: np.ndarray, radius: int, step: int = 512, sets: list[np.ndarray] | None = None, least: float = 0.0, width: int = 1) -> np.ndarray:
    """Links (place, place of root) that span what lies within the radius.

    words: a row of 64-bit words for each entry; sets: its shingles of `width` words in order, if
    linked entries are to be alike() by `least`, too.
    """
    pops = np.bitwise_count(words).sum(axis=1, dtype=np.int32)
    order = np.argsort(pops, kind="stable")
    f, pops = words[order], pops[order]
    root = np.arange(len(f))
    distinct = [np.unique(x) for x in sets] if sets is not None else []
    sizes = np.array([len(distinct[k]) for k in order] if sets is not None else [], np.float64)

    def like(i: np.ndarray, j: np.ndarray, a: int, b: int) -> np.ndarray:
        """Which pairs of two tiles that begin at a and b have a cosine of LIKE."""
        common = common_counts([distinct[k] for k in order[a : a + step]], [distinct[k] for k in order[b : b + step]])[i - a, j - b]
        return common.astype(np.float64) ** 2 >= LIKE * LIKE * sizes[i] * sizes[j] * (1 - 1e-12)

    def good_pair(x: int, y: int) -> bool:
        x, y = order[x], order[y]
        return alike(sets[x], sets[y], least, width, (distinct[x], distinct[y]))

    for a in range(0, len(f), step):
        left = f[a : a + step]
        top = pops[min(a + step, len(f)) - 1]
        for b in range(a, len(f), step):
            if pops[b] - top > radius:
                break  # sorted by population count: all later tiles are farther still
            right = f[b : b + step]
            apart = sum(np.bitwise_count(left[:, None, k] ^ right[None, :, k]).astype(np.int16) for k in range(f.shape[1]))
            i, j = np.nonzero(apart <= radius)
            i, j, few = i + a, j + b, 64
            if sets is not None:
                other = root[i] != root[j]
                i, j = i[other], j[other]
                if len(i) > TOGETHER:
                    good = like(i, j, a, b)
                    i, j = i[good], j[good]
            while True:
                other = root[i] != root[j]
                i, j = i[other], j[other]
                if not len(i):
                    break
                if sets is not None:
                    # a few at a time: what they link needs no further look
                    tried, i, j = (i[:few], j[:few]), i[few:], j[few:]
                    good = np.array([good_pair(x, y) for x, y in zip(*tried)])
                    few = 64 if good.any() else min(2 * few, 4096)
                    if not good.any():
                        continue
                    rest, (i, j) = (i, j), (tried[0][good], tried[1][good])
                # hook the larger root to the smaller, then shorten all paths
                while len(i):
                    np.minimum.at(root, np.maximum(root[i], root[j]), np.minimum(root[i], root[j]))
                    while not np.array_equal(up := root[root], root):
                        root = up
                    other = root[i] != root[j]
                    i, j = i[other], j[other]
                if sets is not None:
                    i, j = rest
    bound = np.flatnonzero(root != np.arange(len(f)))
    return np.stack([order[bound], order[root[bound]]], axis=1)


def _linked(batches: Iterator[pa.RecordBatch], radius: int, least: float = 0.0, width: int = 1) -> Iterator[pa.RecordBatch]:
    """Rows (unit, node, words, and a set if there is one), sorted by unit, to links. A unit may go over several batches."""

    def links(held: list[tuple[pa.Array, np.ndarray]], sets: list[np.ndarray]) -> pa.RecordBatch:
        nodes, words = pa.concat_arrays([n for n, _ in held]), np.concatenate([w for _, w in held])
        uv = spanning_links(np.ascontiguousarray(words).view(np.uint64), radius, sets=sets or None, least=least, width=width)
        return pa.RecordBatch.from_arrays([nodes.take(pa.array(uv[:, 0])), nodes.take(pa.array(uv[:, 1]))], ["u", "v"])

    now, held, sets = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = batch.schema.get_field_index("node")
        unit, rows = (np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in part], axis=1) for part in (batch.columns[:cut], [c for c, n in zip(batch.columns, batch.schema.names) if n[0] == "w"]))
        nodes, own = batch.column("node"), []
        if "set" in batch.schema.names:
            members = batch.column("set")
            flat, ends = members.flatten().to_numpy(zero_copy_only=False), np.cumsum(members.value_lengths().to_numpy(zero_copy_only=False))
            own = np.split(flat, ends[:-1])
        cuts = [0, *(np.flatnonzero((unit[1:] != unit[:-1]).any(axis=1)) + 1).tolist(), len(unit)]
        for a, b in zip(cuts, cuts[1:]):
            if (key := unit[a].tolist()) != now:
                if sum(len(n) for n, _ in held) > 1:
                    yield links(held, sets)
                now, held, sets = key, [], []
            held.append((nodes.slice(a, b - a), rows[a:b]))
            sets += own[a:b]
    if sum(len(n) for n, _ in held) > 1:
        yield links(held, sets)


def bucket_links(keyed: DataFrame, words: list[str], radius: int, tile: int, least: float | None = None, width: int = 1) -> DataFrame:
    """Rows (c, k, node, words) to links (u, v) of nodes within the radius that share a bucket (c, k).

    With `least`, rows have their shingles of `width` words too, as `set`, in order, and linked nodes
    are alike() by that; the tile then counts shingles.
    """
    held = [*words, "set"] if least is not None else words
    weight = F.sum(F.size("set") + 16) if least is not None else F.count("*")
    pops = sum((F.bit_count(w) for w in words[1:]), F.bit_count(words[0]))
    keyed = keyed.withColumn("p", pops)
    counts = keyed.groupBy("c", "k", "p").agg(weight.alias("n"))
    hot_keys = counts.groupBy("c", "k").agg(F.sum("n").alias("all")).where(F.col("all") > tile).select("c", "k")
    # neighbouring population counts share a bin of about `tile` entries; a key has 64 counts a word at most
    before = F.sum("n").over(Window.partitionBy("c", "k").orderBy("p")) - F.col("n")
    hot = stored(counts.join(hot_keys, ["c", "k"]).withColumn("bin", F.floor(before / tile).cast("int")), "hot-buckets")
    node = keyed.schema["node"].dataType
    out, link = T.StructType([T.StructField("u", node), T.StructField("v", node)]), partial(_linked, radius=radius, least=least or 0.0, width=width)
    cold = keyed.join(hot.select("c", "k").distinct(), ["c", "k"], "left_anti").select("c", "k", "node", *held)
    links = cold.repartition("c", "k").sortWithinPartitions("c", "k").mapInArrow(link, out)
    if hot.isEmpty():
        return links
    bins = hot.groupBy("c", "k", "bin").agg(F.min("p").alias("low"), F.max("p").alias("high"), F.ceil(F.sum("n") / (2 * tile)).cast("int").alias("parts"))
    tiles = bins.withColumn("s", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    a = tiles.select("c", "k", F.col("bin").alias("p1"), F.col("s").alias("s1"), "high")
    b = tiles.select("c", "k", F.col("bin").alias("p2"), F.col("s").alias("s2"), "low")
    near = (F.col("low") - F.col("high") <= radius) & ((F.col("p1") < F.col("p2")) | ((F.col("p1") == F.col("p2")) & (F.col("s1") <= F.col("s2"))))
    pairs = a.join(b, ["c", "k"]).where(near).drop("low", "high")
    own = keyed.join(hot.select("c", "k", "p", "bin"), ["c", "k", "p"]).drop("p").join(bins.select("c", "k", "bin", "parts"), ["c", "k", "bin"])
    own = own.withColumnRenamed("bin", "p").withColumn("s", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    unit = ["c", "k", "p1", "s1", "p2", "s2"]
    left = own.withColumnsRenamed({"p": "p1", "s": "s1"}).join(pairs, ["c", "k", "p1", "s1"]).select(*unit, "node", *held)
    right = own.withColumnsRenamed({"p": "p2", "s": "s2"}).join(pairs, ["c", "k", "p2", "s2"]).where("p1 <> p2 or s1 <> s2").select(*unit, "node", *held)
    both = left.union(right).repartition(*unit).sortWithinPartitions(*unit)
    return links.union(both.mapInArrow(link, out))


def near_links(distinct: DataFrame, radius: int, tile: int = 4096) -> DataFrame:
    """Distinct fp values to links (u, v) that span every component within the radius."""
    masks = block_masks(blocks_for(distinct.count(), radius), radius)
    pick = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks)]))
    keyed = distinct.select("fp", pick.alias("b")).select("b.c", "b.k", F.col("fp").alias("node"), F.col("fp").alias("w0"))
    return bucket_links(keyed, ["w0"], radius, tile)


def _wide_fingerprints(batches: Iterator[pa.RecordBatch], width: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [wide_fingerprint(x, width) for x in b.column(2).to_pylist()]
        words = [pa.array([w[i] for w, _ in found], pa.int64()) for i in range(WIDE_WORDS)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *words, pa.array([k for _, k in found], pa.list_(pa.int64()))], names)


def _shingle_sets(batches: Iterator[pa.RecordBatch], width: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Puts the shingle hashes, in order, in place of the text, the last column."""
    from siltbed.llm.bpe import slices

    for b in batches:
        texts = b.column(b.num_columns - 1).to_pylist()
        for i, j in slices([t or "" for t in texts], SLICE_CHARS):
            sets = [shingle_hashes(t, width, True).view(np.int64) for t in texts[i:j]]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            members = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *sets])))
            yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns[:-1], members], names)


def _shared(named: DataFrame, words: list[str]) -> DataFrame:
    """Rows (c, k, node, words) of the keys that two texts or more have; those that one text has need no comparison.

    Two texts of one short digest both get the other's keys: more candidates, none lost.
    """
    short = F.xxhash64("h").alias("e")
    keyed = named.select(short, F.posexplode("keys").alias("c", "k"))
    held = keyed.withColumn("n", F.count("*").over(Window.partitionBy("c", "k"))).where("n > 1").drop("n")
    return held.join(named.select(short, F.col("h").alias("node"), *words), "e").select("c", "k", "node", *words)


def _checked(candidates: DataFrame, named: DataFrame, docs: DataFrame, text_col: str, words: list[str], width: int, least: float) -> DataFrame:
    """Links (u, v) of candidates (node, root) of one root that are copies by their shingles."""
    near = candidates.join(named, candidates.node == named.h).select(F.xxhash64("root").alias("c"), F.xxhash64(F.lit(1), "root").alias("k"), "node", *words)
    texts = docs.select(_digest(text_col).alias("node"), F.col(f"`{text_col}`").alias("text"))
    if wanted := key_filter(candidates, ["node"]):
        texts, _ = wanted.part(texts)
    # one text a digest before they meet, so a text of many rows moves once a task; words and sets in one row at once
    both = near.join(texts.groupBy("node").agg(F.min("text").alias("text")), "node").select(*near.columns, "text")
    kind = T.StructType([*near.schema.fields, T.StructField("set", T.ArrayType(T.LongType()))])
    keyed = stored(both.mapInArrow(partial(_shingle_sets, width=width, names=kind.names), kind), "copies-sets")
    return bucket_links(keyed, words, WIDE_RADIUS, SET_TILE, least, width)


def _first_of_copies(docs: DataFrame, id_col: str, text_col: str, width: int, tile: int, least: float) -> tuple[DataFrame, DataFrame]:
    """(id, h) of the first row, by id (null last), of each class of copies; (id, h) of all rows."""
    kind = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("h", T.StringType()), *[T.StructField(f"w{i}", T.LongType()) for i in range(WIDE_WORDS)], T.StructField("keys", T.ArrayType(T.LongType()))])
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), _digest(text_col).alias("h"), F.col(f"`{text_col}`").alias("text"))
    words = [f"w{i}" for i in range(WIDE_WORDS)]
    rows = stored(rows.mapInArrow(partial(_wide_fingerprints, width=width, names=kind.names), kind), "copies")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("h"))).alias("best")
    named = stored(rows.groupBy("h", *words, "keys").agg(first), "copies-distinct")
    with last_kept(docs.sparkSession):
        shared = stored(_shared(named, words), "copies-shared")
        candidates = stored(components(bucket_links(shared, words, WIDE_RADIUS, tile)), "copies-candidates")
    with last_kept(docs.sparkSession):
        joined = stored(components(_checked(candidates, named, docs, text_col, words, width, least)), "copies-components")
    rooted = named.select("h", "best").join(joined, F.col("h") == F.col("node"), "left").select(F.coalesce("root", "h").alias("root"), "best")
    best = stored(rooted.groupBy("root").agg(F.min("best").alias("best")).select("best.id", "best.h"), "copies-first")
    forget(docs.sparkSession, named)
    return best, rows.select("id", "h")


def _classes(docs: DataFrame, id_col: str, text_col: str, radius: int, width: int, tile: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, h, fp), and for each fp the first row (null ids last) of its component."""
    fps = stored(fingerprints(docs, id_col, text_col, width), "simhash")
    row = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("h"))
    named = stored(fps.groupBy("fp").agg(F.min(row).alias("best"), F.count("*").alias("n")), "simhash-distinct")
    joined = stored(components(near_links(named.select("fp"), radius, tile)), "simhash-components")
    rooted = joined.join(named, joined.node == named.fp)
    best = rooted.groupBy("root").agg(F.min("best").alias("first"))
    linked = rooted.join(best, "root").select("fp", "first")
    return fps, named.join(linked, "fp", "left").select("fp", F.coalesce("first", "best").alias("first"), "n")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, width: int = SHINGLE, tile: int = 4096) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) for each row of docs."""
    fps, classes = _classes(docs, id_col, text_col, radius, width, tile)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    found = looked_up(fps, classes, "fp", "n", F.struct("id", "h"))
    return found.select(F.col("id").alias(id_col), hexed, F.col("first.id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, tile: int = 32768, least: float = COPIES) -> DataFrame:
    """One row of docs for each class of copies, the one with the least id; columns as given.

    least: the similarity from which texts are copies; below 0.8 more of them may share no key.
    Rows that share an id are told apart by their text; of equal rows one stays.
    The join is on id and text digest, so no group of copies meets in one task.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    at = {c.lower(): n for c, n in zip(docs.columns, names)}
    rows, own_id, own_text = docs.toDF(*names), at[id_col.lower()], at[text_col.lower()]
    first, all_rows = _first_of_copies(rows, own_id, own_text, width, tile, least)
    # the same three keys for the joins and for equal rows
    keys = [F.coalesce(F.col("id").cast("string"), F.lit("")).alias("_i"), F.col("id").isNull().alias("_n"), F.col("h").alias("_h")]
    by, best = ["_i", "_n", "_h"], first.select(*keys)
    # rows that go or are repeated; all others stay where they are
    counted = all_rows.select(*keys).groupBy(*by).agg(F.count("*").alias("n"))
    gone = stored(counted.join(best.withColumn("stays", F.lit(True)), by, "left").where("stays is null or n > 1").select(*by), "copies-gone")
    keyed = rows.select(F.col(own_id).alias("id"), _digest(own_text).alias("h"), *names).select(*keys, *names)
    touched = key_filter(gone, by)
    may, rest = touched.part(keyed) if touched else (keyed, None)
    kept = may.join(best, by, "left_semi").dropDuplicates(by).select(*names)
    return (kept if rest is None else rest.select(*names).union(kept)).toDF(*docs.columns)
