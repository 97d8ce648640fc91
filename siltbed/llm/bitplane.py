"""Token ids in plane-shuffled files.

A file is self-contained: blocks of a fixed number of ids, each transposed into
byte planes (or bit planes) that are compressed one by one with zstandard, then
an index of all planes and of the documents, then a trailer. Documents lie end
to end and cross blocks; a file has at least one document and about FILE_IDS ids.

Files travel as rows (part, seq, before, n_tokens, data), written by Spark to the
shared folder, so that a lost executor costs a task and no half-written file is
ever seen. Parts are ranges of ids in ascending order, null first; rows that
share an id follow the digest of their text. `before` counts the ids of the same
part that come before the file; a sum over the parts makes it a global place.

Defined results: null and empty texts have the end id only; repeated rows
repeat; very long documents fill a file of their own; an empty table gives no
file. Ids are integers or strings, TypeError else. Ties: rows of one id and one text
are equal, so their order shows nowhere. Columns of the caller may have any name: files
hold ids and tokens only.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from siltbed.llm.bpe import Pool, library_pool, slices
from siltbed.llm.common import stored

MAGIC = b"PLANES1\n"
BLOCK_IDS, FILE_IDS = 1 << 16, 1 << 20
FILES = "part int, seq int, before long, n_tokens long, data binary"


def to_planes(ids: np.ndarray, bits: bool) -> np.ndarray:
    """The ids' 4 byte planes, or 32 bit planes, one a row."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return np.ascontiguousarray(raw.T)
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1, bitorder="little")


def from_planes(planes: np.ndarray, n: int, bits: bool) -> np.ndarray:
    if bits:
        planes = np.packbits(np.unpackbits(planes, axis=1, count=n, bitorder="little").T, axis=1, bitorder="little").T
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def write_file(ids: np.ndarray, doc_ids: list, counts: list[int], bits: bool = False, level: int = 3) -> bytes:
    """A file of documents end to end; counts: ids of each."""
    pack = zstandard.ZstdCompressor(level=level)
    out, index, at = [MAGIC], [], len(MAGIC)
    for k in range(0, len(ids), BLOCK_IDS):
        block = ids[k : k + BLOCK_IDS]
        frames = [pack.compress(p.tobytes()) for p in to_planes(block, bits)]
        index.append([at, len(block), [len(f) for f in frames]])
        out += frames
        at += sum(map(len, frames))
    foot = pack.compress(json.dumps({"bits": bits, "blocks": index, "docs": doc_ids, "counts": counts}).encode())
    return b"".join([*out, foot, struct.pack("<QQ", at, len(foot)), MAGIC])


class PlaneFile:
    """Reads a file by its index; blocks are decompressed as they are asked for."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC or data[-len(MAGIC) :] != MAGIC:
            raise ValueError("not a plane file")
        self.data, self.unpack = data, zstandard.ZstdDecompressor()
        at, size = struct.unpack("<QQ", data[-len(MAGIC) - 16 : -len(MAGIC)])
        foot = json.loads(self.unpack.decompress(data[at : at + size]))
        self.bits, self.blocks, self.docs = foot["bits"], foot["blocks"], foot["docs"]
        self.ends = np.cumsum([0, *foot["counts"]])

    def block(self, k: int) -> np.ndarray:
        at, n, sizes = self.blocks[k]
        planes = []
        for size in sizes:
            planes.append(np.frombuffer(self.unpack.decompress(self.data[at : at + size]), np.uint8))
            at += size
        return from_planes(np.stack(planes), n, self.bits)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids of this range of places; reads the blocks that hold it only."""
        first = start // BLOCK_IDS
        held = [self.block(k) for k in range(first, -(-end // BLOCK_IDS))]
        return np.concatenate([np.empty(0, "<u4"), *held])[start - first * BLOCK_IDS : end - first * BLOCK_IDS]

    def documents(self) -> Iterator[tuple[object, int, np.ndarray]]:
        """(id, place of its first id, its ids) of each document."""
        ids = self.ids(0, int(self.ends[-1]))
        for d, a, b in zip(self.docs, self.ends, self.ends[1:]):
            yield d, int(a), ids[a:b]


@lru_cache(maxsize=2)
def library(path: str) -> Pool:
    """The tokenizers library's encoder, with the ids of words met, once per Python worker."""
    return library_pool(path)


def _write(batches: Iterator[pa.RecordBatch], path: str, end_id: int, bits: bool) -> Iterator[pa.RecordBatch]:
    pool, part, seq, before = library(path), TaskContext.get().partitionId(), 0, 0
    kind = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("data", pa.binary())])
    docs, counts, held, size = [], [], [], 0

    def give() -> pa.RecordBatch:
        data = write_file(np.concatenate(held), docs, counts, bits)
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((part, seq, before, size, data), kind)], schema=kind)

    for b in batches:
        names, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
        for i, j in slices(texts):
            ids, n = pool.encode_batch(texts[i:j])
            ends = np.cumsum(n)
            held.append(np.insert(ids.astype("<u4"), ends, end_id))
            docs += names[i:j]
            counts += (n + 1).tolist()
            size += int(ends[-1]) + j - i
            if size >= FILE_IDS:
                yield give()
                seq, before = seq + 1, before + size
                docs, counts, held, size = [], [], [], 0
    if size:
        yield give()


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, bits: bool = False) -> DataFrame:
    """Encodes whole texts and writes them as files in ascending order of ids; returns the files' rows."""
    spark = docs.sparkSession
    if not isinstance(docs.schema[id_col].dataType, (T.IntegralType, T.StringType)):
        raise TypeError(f"{id_col} must be an integer or string column")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    key = [F.col("id"), F.xxhash64("text")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *key).sortWithinPartitions(*key)
    return stored(rows.mapInArrow(partial(_write, path=path, end_id=end_id, bits=bits), FILES), "plane-files", "uncompressed")


def _read(batches: Iterator[pa.RecordBatch], names: list[str], kinds: pa.Schema) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            found = [(d, row["start"] + a, len(x), x.tobytes()) for d, a, x in PlaneFile(row["data"]).documents()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), kinds)], schema=kinds)


def read(files: DataFrame, id_type: T.DataType = T.LongType(), id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids: little-endian 32-bit words) of each document of the files."""
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row for each partition that wrote
    offsets = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    placed = files.join(offsets, "part").select((F.col("offset") + F.col("before")).alias("start"), "data")
    kind = T.StructType([T.StructField(id_col, id_type), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    if not isinstance(id_type, (T.IntegralType, T.StringType)):
        raise TypeError(f"{id_col} must be an integer or string column")
    arrow = to_arrow_type(id_type)
    kinds = pa.schema([(id_col, arrow), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    return placed.mapInArrow(partial(_read, names=kind.names, kinds=kinds), kind)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes docs, reads the files back: id, start, n_tokens and crc32 of the ids."""
    found = read(write(docs, path, id_col, text_col), docs.schema[id_col].dataType, id_col)
    return found.select(F.col(f"`{id_col}`"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
