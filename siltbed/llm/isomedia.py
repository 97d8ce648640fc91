"""ISO base media containers: a writer of raw 8-bit video, and a prober of any file.

A payload becomes 24 x 24 grey frames, one byte a sample ("uncv"), 16 frames a
chunk, the first frame of each chunk a random access point. Containers are
written to the shared folder by Spark and read back. The prober walks the nested
boxes and takes each track's own sample tables (stts, stsc, stsz or stz2, stco or
co64, stss) or, in fragmented files, its runs (tfhd, tfdt, trun with the defaults of
trex), and gives codec, duration and the byte ranges of keyframes, without touching
the payload.

Defined results: null and empty texts have one frame of padding; repeated rows
repeat; very long texts have as many frames as they need; bytes that are no
container raise ValueError in the prober; an empty table gives an empty table. Ties:
tracks are in the order of the file, the first is the one that is read back. Columns
of the caller may have any name: the result has the id and what is probed only.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import stored

#: A frame's side and bytes, the padding.
SIDE, FRAME, PAD = 24, 576, b"\xff"
CHUNK_FRAMES, RATE = 16, 25
#: Kinds that a path of nested boxes names at most, the last ones.
DEEPEST = 8
NESTED = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"mvex", b"moof", b"traf", b"udta"}


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


def table(kind: bytes, rows: np.ndarray, width: str = ">u4") -> bytes:
    return full(kind, struct.pack(">I", len(rows)), np.asarray(rows).astype(width).tobytes())


def pad(payload: bytes) -> bytes:
    """The payload up to a positive multiple of a frame."""
    return payload + PAD * (-len(payload) % FRAME if payload else FRAME)


def write_container(payload: bytes) -> bytes:
    """A container whose samples are the frames of a padded payload."""
    frames = len(payload) // FRAME
    chunks = -(-frames // CHUNK_FRAMES)
    matrix = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    last = frames - (chunks - 1) * CHUNK_FRAMES
    runs = [(1, CHUNK_FRAMES, 1)] * (chunks > 1) + [(chunks, last, 1)] * (chunks == 1 or last < CHUNK_FRAMES)
    entry = box(b"uncv", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIII", SIDE, SIDE, 0x480000, 0x480000, 0), struct.pack(">H", 1), bytes(32), struct.pack(">Hh", 8, -1))
    head = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")
    large = len(payload) + 4096 + 24 * chunks >= 1 << 32

    def moov(base: int) -> bytes:
        offsets = base + np.arange(chunks, dtype=np.int64) * (CHUNK_FRAMES * FRAME)
        tables = [
            full(b"stsd", struct.pack(">I", 1), entry),
            table(b"stts", np.array([(frames, 1)])),
            table(b"stsc", np.array(runs)),
            full(b"stsz", struct.pack(">II", FRAME, frames)),
            table(b"co64", offsets, ">u8") if large else table(b"stco", offsets),
            table(b"stss", np.arange(chunks) * CHUNK_FRAMES + 1),
        ]
        minf = box(b"minf", full(b"vmhd", bytes(8), flags=1), box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1))), box(b"stbl", *tables))
        mdia = box(b"mdia", full(b"mdhd", struct.pack(">IIIIHH", 0, 0, RATE, frames, 0x55C4, 0)), full(b"hdlr", bytes(4), b"vide", bytes(12), b"frames\0"), minf)
        tkhd = full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, frames), bytes(16), matrix, struct.pack(">II", SIDE << 16, SIDE << 16), flags=3)
        mvhd = full(b"mvhd", struct.pack(">IIIIIH", 0, 0, RATE, frames, 0x10000, 0x100), bytes(10), matrix, bytes(24), struct.pack(">I", 2))
        return box(b"moov", mvhd, box(b"trak", tkhd, mdia))

    body = box(b"mdat", payload)
    base = len(head) + len(moov(0)) + len(body) - len(payload)
    return head + moov(base) + body


def walk(data: bytes) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path of kinds, start, end of the body) of every box, nested ones included; paths end with a box's last DEEPEST kinds."""
    levels = [(0, len(data), ())]
    while levels:
        start, end, path = levels.pop()
        if start + 8 > end:
            continue
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1:
            (size,) = struct.unpack_from(">Q", data, body)
            body += 8
        stop = end if size == 0 else start + size
        if stop < body or stop > end:
            raise ValueError(f"a box of a wrong size at {start}")
        own = (*path, kind)[-DEEPEST:]
        yield own, body, stop
        levels.append((stop, end, path))
        if kind in NESTED:
            levels.append((body, stop, own))


@dataclass
class Track:
    codec: str
    timescale: int
    duration: int
    offsets: np.ndarray
    sizes: np.ndarray
    keyframes: np.ndarray

    def ranges(self) -> np.ndarray:
        """Start and end of each keyframe in the file."""
        at = self.offsets[self.keyframes]
        return np.stack([at, at + self.sizes[self.keyframes]], axis=1)

    def payload(self, data: bytes) -> bytes:
        """All samples' bytes; neighbours are read at once."""
        ends = self.offsets + self.sizes
        cut = np.flatnonzero(self.offsets[1:] != ends[:-1]) + 1
        first, last = np.r_[0, cut], np.r_[cut, len(ends)] - 1
        return b"".join(data[a:b] for a, b in zip(self.offsets[first], ends[last]))


def rows_of(data: bytes, at: int, width: int, word: str = ">u4") -> np.ndarray:
    """The rows of a full box with a count."""
    (n,) = struct.unpack_from(">I", data, at + 4)
    return np.frombuffer(data, word, n * width, at + 8).reshape(n, width).astype(np.int64)


def sample_sizes(data: bytes, boxes: dict[bytes, int]) -> np.ndarray:
    if (at := boxes.get(b"stsz")) is not None:
        size, n = struct.unpack_from(">II", data, at + 4)
        if size and n * size > len(data):
            raise ValueError("more samples than the container has bytes")
        return np.full(n, size, np.int64) if size else np.frombuffer(data, ">u4", n, at + 12).astype(np.int64)
    width, n = struct.unpack_from(">BI", data, boxes[b"stz2"] + 7)
    if width == 4:
        return np.frombuffer(data, np.uint8, -(-n // 2), boxes[b"stz2"] + 12).repeat(2).astype(np.int64)[:n] >> np.where(np.arange(n) % 2, 0, 4) & 15
    return np.frombuffer(data, f">u{width // 8}", n, boxes[b"stz2"] + 12).astype(np.int64)


def fragment_samples(data: bytes, at: int, end: int, base: int, known: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """Offsets, sizes, whether each is a keyframe, duration and end of the data of one trun.

    known: a sample's duration, size and flags where the run says nothing.
    """
    flags, n = struct.unpack_from(">II", data, at)
    flags &= 0xFFFFFF
    at += 8
    first = None
    if flags & 1:
        base += struct.unpack_from(">i", data, at)[0]
        at += 4
    if flags & 4:
        (first,) = struct.unpack_from(">I", data, at)
        at += 4
    held = [k for k, bit in enumerate((0x100, 0x200, 0x400, 0x800)) if flags & bit]
    if at + 4 * n * len(held) > end:
        raise ValueError("a run of samples that ends too early")
    if not held and n * max(known[1], 1) > end + len(data):
        raise ValueError("more samples than the container has bytes")
    given = np.frombuffer(data, ">u4", n * len(held), at).reshape(n, len(held)).astype(np.int64)
    value = [given[:, held.index(k)] if k in held else np.full(n, known[k], np.int64) for k in range(3)]
    if first is not None and n:
        value[2] = np.r_[first, value[2][1:]]
    offsets = base + np.cumsum(value[1]) - value[1]
    return offsets, value[1], value[2] & 0x10000 == 0, int(value[0].sum()), base + int(value[1].sum())


def probe_tracks(data: bytes) -> list[Track]:
    """All tracks of a container, in the order of the file; ValueError for whatever is none."""
    try:
        return _tracks(data)
    except (struct.error, IndexError, KeyError, OverflowError) as e:
        raise ValueError(f"a container that ends too early: {e}") from e


def _tracks(data: bytes) -> list[Track]:
    tracks: list[dict[bytes, int]] = []
    defaults: dict[int, tuple[int, ...]] = {}
    runs: dict[int, list] = {}
    moof = base = end_of_last = 0
    now, known = 0, [0, 0, 0]
    for path, a, b in walk(data):
        if path[-1] == b"trak":
            tracks.append({})
        elif len(path) > 1 and path[-2] in (b"trak", b"mdia", b"stbl") and tracks:
            tracks[-1].setdefault(path[-1], a)
        elif path[-1] == b"trex":
            track, _, *rest = struct.unpack_from(">5I", data, a + 4)
            defaults[track] = tuple(rest)
        elif path[-1] == b"moof":
            moof = end_of_last = a - 8
        elif path[-1] == b"tfhd":
            flags, now = struct.unpack_from(">II", data, a)
            at, base, known = a + 8, end_of_last if not flags & 0x20000 else moof, list(defaults.get(now, (0, 0, 0)))
            if flags & 1:
                (base,) = struct.unpack_from(">Q", data, at)
                at += 8
            at += 4 if flags & 2 else 0
            first = True
            for k, bit in enumerate((8, 0x10, 0x20)):
                if flags & bit:
                    (known[k],) = struct.unpack_from(">I", data, at)
                    at += 4
        elif path[-1] == b"trun":
            # without an offset of its own a run follows the one before
            found = fragment_samples(data, a, b, base if data[a + 3] & 1 or first else end_of_last, known)
            first, end_of_last = False, found[-1]
            runs.setdefault(now, []).append(found)
    out = [_track(data, boxes, runs.get(struct.unpack_from(">I", data, boxes[b"tkhd"] + (20 if data[boxes[b"tkhd"]] else 12))[0], []) if b"tkhd" in boxes else []) for boxes in tracks]
    if not out:
        raise ValueError("no track with sample tables")
    return out


def _track(data: bytes, boxes: dict[bytes, int], runs: list) -> Track:
    if not {b"mdhd", b"stsd", b"stts", b"stsc"} <= boxes.keys() or not boxes.keys() & {b"stsz", b"stz2"}:
        raise ValueError("no track with sample tables")
    a = boxes[b"mdhd"]
    timescale, duration = struct.unpack_from(">IQ", data, a + 20) if data[a] else struct.unpack_from(">II", data, a + 12)
    a = boxes[b"stsd"]
    codec = data[a + 12 : a + 16].decode("latin-1")
    sizes = sample_sizes(data, boxes)
    n = len(sizes)
    chunk = (rows_of(data, boxes[b"co64"], 1, ">u8") if b"co64" in boxes else rows_of(data, boxes[b"stco"], 1) if b"stco" in boxes else np.empty((0, 1), np.int64))[:, 0]
    per = rows_of(data, boxes[b"stsc"], 3)
    per_chunk = np.repeat(per[:, 1], np.diff(np.r_[per[:, 0] - 1, len(chunk)]))
    if per_chunk.sum() != n or rows_of(data, boxes[b"stts"], 2)[:, 0].sum() != n:
        raise ValueError("sample tables that disagree")
    owner = np.repeat(np.arange(len(chunk)), per_chunk)
    before = np.cumsum(sizes) - sizes
    first = before[(np.cumsum(per_chunk) - per_chunk)[per_chunk > 0]] if n else before
    offsets = chunk[owner] + before - np.repeat(first, per_chunk[per_chunk > 0])
    keys = rows_of(data, boxes[b"stss"], 1)[:, 0] - 1 if b"stss" in boxes else np.arange(n)
    for more, own, key, time, _ in runs:
        keys = np.r_[keys, len(offsets) + np.flatnonzero(key)]
        offsets, sizes, duration = np.r_[offsets, more], np.r_[sizes, own], duration + time
    return Track(codec, timescale, duration, offsets, sizes, keys)


def probe(data: bytes) -> Track:
    """The first track of a container."""
    return probe_tracks(data)[0]


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, 64):
            part = b.slice(k, 64)
            media = [write_container(pad((t or "").encode("utf-8", "surrogatepass"))) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(media, pa.binary())], ["id", "media"])


PROBED = [("codec", T.StringType(), pa.string()), ("timescale", T.LongType(), pa.int64()), ("duration", T.LongType(), pa.int64()), ("frames", T.LongType(), pa.int64()), ("keyframes", T.StringType(), pa.string()), ("n_bytes", T.LongType(), pa.int64()), ("payload_bytes", T.LongType(), pa.int64()), ("payload_sha256", T.StringType(), pa.string()), ("tail_crc32", T.LongType(), pa.int64()), ("media_bytes", T.LongType(), pa.int64()), ("media_sha256", T.StringType(), pa.string()), ("mean_level", T.DoubleType(), pa.float64())]


def _probe(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = []
        for data in b.column(1):
            media = data.as_py()
            track = probe(media)
            payload = track.payload(media)
            # byte 255 never occurs in UTF-8, so what is padded can be told
            found.append((track.codec, track.timescale, track.duration, len(track.sizes), ",".join(f"{x}-{y}" for x, y in track.ranges()), len(payload.rstrip(PAD)), len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), sha256(media).hexdigest(), float(np.frombuffer(payload, np.uint8).mean())))
        cols = [pa.array(c, t) for c, (_, _, t) in zip(zip(*found), PROBED)] if found else [pa.array([], t) for _, _, t in PROBED]
        yield pa.RecordBatch.from_arrays([b.column(0), *cols], names)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, media): a container for each row, written to the shared folder."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("media", T.BinaryType())])
    return stored(rows.mapInArrow(_store, kind), "media")


def probed(media: DataFrame) -> DataFrame:
    """(id, codec, duration, keyframe byte ranges and more) of each stored container."""
    kind = T.StructType([media.schema["id"], *[T.StructField(n, t) for n, t, _ in PROBED]])
    return media.mapInArrow(partial(_probe, names=kind.names), kind)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores each row's container, reads it back: sizes, digests and a feature string."""
    found = probed(store(docs, id_col, text_col))
    feature = F.concat_ws(";", F.concat(F.lit("codec="), "codec"), F.concat(F.lit("duration="), "duration", F.lit("/"), "timescale"), F.concat(F.lit("frames="), "frames"), F.concat(F.lit("keyframes="), "keyframes"), F.concat(F.lit("level="), F.format_number("mean_level", 3)))
    return found.select(F.col("id").alias(id_col), "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))
