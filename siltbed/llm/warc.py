"""WARC archives of pages, and their index by external merge.

Writing: payload digests are counted first; of records of equal payloads the one
with the least id is the response, the others are revisits that refer to it.
Each task packs its records, a gzip member each, into archives of bounded size,
kept as rows (part, seq, data) that Spark writes to the shared folder.

Reading: each archive gives one run, its captures sorted by URL key, timestamp and
id, written to the shared folder as blocks of BLOCK_ROWS captures with their first
and last keys. Runs merge in passes of about FAN_IN runs: a group of runs is cut
into ranges of about RANGE_ROWS captures at first keys of its blocks, a range takes
the blocks that reach into it, as they are, and a loser tree merges them run by run,
decoding a block when its turn comes; nothing is sorted again. What a pass gives is
the next one's runs. In the last pass there is one group, its ranges lie in the order
of their keys, and so the partitions in their order are the capture history.

Defined results: a null payload is empty; a null URL has the empty key; records
with a null id are responses, unless an equal payload has an id; rows that share
the least id of their payload are all responses; a payload below min_bytes is
always a response; ids must be integers (TypeError else) and are read back as
longs; repeated rows are records of their own; very long payloads fill an archive
each; an empty table gives no archive and an empty history. Ties: captures of equal
keys follow their archive and offset. Columns of the caller may have any name: the
result has the capture's fields only.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import partial
from hashlib import sha1
from itertools import islice
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import looked_up, stored
from siltbed.operators import ordered

ARCHIVE_BYTES = 8 << 20
RANGE_ROWS, BLOCK_ROWS, FAN_IN = 100_000, 1024, 64
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVES = "part int, seq int, data binary"
FIELDS = ["url_key", "timestamp", "page_id", "run", "offset", "length", "record_type", "refers_to", "payload_bytes", "payload_digest"]
RUNS = "url_key string, timestamp string, page_id long, run string, offset long, length long, record_type string, refers_to long, payload_bytes long, payload_digest string"
KEY = "struct<url_key: string, timestamp: string, known: boolean, page_id: long, run: string, offset: long>"
BLOCKS = f"run string, seq long, n long, first {KEY}, last {KEY}, data binary"
RUNS_ARROW = pa.schema([(n, pa.int64() if n in ("page_id", "offset", "length", "refers_to", "payload_bytes") else pa.string()) for n in FIELDS])


def url_key(url: str | None) -> str:
    """The host's labels from the right, then the path and query: one site sorts together."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url
    if not host:
        return url
    host = re.sub(r"^www\d*\.", "", host)
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "") + ")" + (parts.path or "/")
    return key + (f"?{parts.query}" if parts.query else "")


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    return int(urn[10:-1]) if len(urn) > 11 else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One record; the caller compresses it."""
    uri = re.sub(r"[^\x21-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "surrogatepass")), url or "")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    else:
        block += payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def members(data: bytes, step: int = 1 << 16) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member."""
    at = 0
    while at < len(data):
        unpack, out, fed = zlib.decompressobj(31), [], at
        while not unpack.eof:
            if fed >= len(data):
                raise ValueError(f"a truncated record at {at}")
            out.append(unpack.decompress(data[fed : fed + step]))
            fed = min(len(data), fed + step)
        end = fed - len(unpack.unused_data)
        yield at, end - at, b"".join(out)
        at = end


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers of a record, by lower-case name, and its block."""
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(sha1(payload).digest()).decode()


def _write(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0
    fields = b"format: WARC File Format 1.1\r\n"
    info = gzip_member(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:archive:%d>\r\nWARC-Date: %s\r\nContent-Type: application/warc-fields\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (part, DATE.encode(), len(fields), fields))

    def give() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([info + b"".join(held)], pa.binary())], ["part", "seq", "data"])

    for b in batches:
        for page_id, url, html, date, first, revisit in zip(*(c.to_pylist() for c in b.columns)):
            payload = (html or "").encode("utf-8", "surrogatepass")
            held.append(gzip_member(record(page_id, url, payload, base32_sha1(payload), first, revisit, date or DATE)))
            size += len(held[-1])
            if size >= most:
                yield give()
                seq, held, size = seq + 1, [], 0
    if held:
        yield give()


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date_col: str | None = None, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record for each row; returns the archives' rows."""
    if not isinstance(pages.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer column")
    date = F.col(f"`{date_col}`").cast("string") if date_col else F.lit(DATE)
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"), date.alias("date"), F.sha1(html.cast("binary")).alias("sha"), (F.octet_length(html) >= min_bytes).alias("large"))
    # payloads of one record only need no partner; counted before texts move
    firsts = rows.where("large").groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    own = looked_up(rows, stored(firsts, "warc-firsts"), "sha", "n", F.struct("page_id", "url"))
    revisit = F.col("large") & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    own = own.select("page_id", "url", "html", "date", "first", revisit.alias("revisit"))
    return stored(own.mapInArrow(partial(_write, most=archive_bytes), ARCHIVES), "warc", "uncompressed")


def entries(data: bytes, run: str) -> list[tuple]:
    """The run of one archive: its captures by URL key, timestamp and id. Checks payload digests."""
    out = []
    for offset, length, content in members(data):
        head, block = parse(content)
        kind = head["warc-type"]
        if kind not in ("response", "revisit"):
            continue
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
            raise ValueError(f"{run} at {offset}: the payload is not what the header says")
        refers = _page(head["warc-refers-to"]) if kind == "revisit" else None
        out.append((url_key(head.get("warc-target-uri")), head["warc-date"], _page(head["warc-record-id"]), run, offset, length, kind, refers, size, digest))
    out.sort(key=order)
    return out


def order(entry: tuple) -> tuple:
    """By URL key, timestamp and id, null first; then by place."""
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[3], entry[4]


def packed(found: list[tuple]) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*found), RUNS_ARROW)], schema=RUNS_ARROW)
    with pa.ipc.new_stream(sink, RUNS_ARROW, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> Iterator[tuple]:
    for batch in pa.ipc.open_stream(data):
        yield from zip(*(c.to_pylist() for c in batch.columns))


BLOCKS_ARROW = pa.schema([("run", pa.string()), ("seq", pa.int64()), ("n", pa.int64())])
KEY_ARROW = pa.struct([("url_key", pa.string()), ("timestamp", pa.string()), ("known", pa.bool_()), ("page_id", pa.int64()), ("run", pa.string()), ("offset", pa.int64())])
for _name, _kind in (("first", KEY_ARROW), ("last", KEY_ARROW), ("data", pa.binary())):
    BLOCKS_ARROW = BLOCKS_ARROW.append(pa.field(_name, _kind))


def block(run: str, seq: int, found: list[tuple]) -> pa.RecordBatch:
    """A row of BLOCKS: sorted captures, with their first and last keys."""
    first, last = (dict(zip(KEY_ARROW.names, order(x))) for x in (found[0], found[-1]))
    row = (run, seq, len(found), first, last, packed(found))
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, BLOCKS_ARROW)], schema=BLOCKS_ARROW)


def _runs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            run = f"{row['part']:06d}-{row['seq']:06d}"
            found = entries(row["data"], run)
            for k in range(0, len(found), rows):
                yield block(run, k // rows, found[k : k + rows])


def runs(archives: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One sorted run for each archive, read from the archives and written to the shared folder in blocks."""
    return stored(archives.mapInArrow(partial(_runs, rows=block_rows), BLOCKS), "warc-runs", "uncompressed")


def loser_tree(sources: list[Iterator[tuple]], key=order) -> Iterator[tuple]:
    """Merges sorted sources: inner nodes keep the loser of a match, so that each step
    replays only the path from one leaf to the root."""
    k = len(sources)
    heads = [next(s, None) for s in sources]
    keys = [None if h is None else key(h) for h in heads]

    def beats(a: int, b: int) -> bool:
        if keys[a] is None or keys[b] is None:
            return keys[b] is None and (keys[a] is not None or a < b)
        return (keys[a], a) < (keys[b], b)

    losers = [-1] * max(k, 1)
    winner = -1
    for leaf in range(k):
        now, node = leaf, (leaf + k) // 2
        while node > 0:
            if losers[node] < 0:
                losers[node] = now
                now = -1
                break
            if beats(losers[node], now):
                losers[node], now = now, losers[node]
            node //= 2
        if now >= 0:
            winner = now
    while k and keys[winner] is not None:
        yield heads[winner]
        heads[winner] = next(sources[winner], None)
        keys[winner] = None if heads[winner] is None else key(heads[winner])
        now, node = winner, (winner + k) // 2
        while node > 0:
            if beats(losers[node], now):
                losers[node], now = now, losers[node]
            node //= 2
        winner = now


def _merged_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, Iterator[tuple]]]:
    """(group, range, merged captures) of rows (group, range, low, high, run, seq, data), sorted by the first two.

    A range's blocks are held packed, about RANGE_ROWS captures and a block or two of each run.
    """
    def key_of(struct: dict | None) -> tuple | None:
        return struct and tuple(struct.values())

    def leaf(own: list[tuple[int, bytes]], low: tuple, high: tuple | None) -> Iterator[tuple]:
        for _, data in sorted(own, key=lambda x: x[0]):  # blocks of a run by their number
            for entry in unpacked(data):
                at = order(entry)
                if high is not None and at >= high:
                    return
                if at >= low:
                    yield entry

    def merged(held: dict[str, list], low: tuple, high: tuple | None) -> Iterator[tuple]:
        return loser_tree([leaf(own, low, high) for _, own in sorted(held.items())])

    now, held, ends = None, {}, (None, None)
    for b in batches:
        for group, nth, low, high, run, seq, data in zip(*(c.to_pylist() for c in b.columns)):
            if (group, nth) != now:
                if held:
                    yield *now, merged(held, *ends)
                now, held, ends = (group, nth), {}, (key_of(low), key_of(high))
            held.setdefault(run, []).append((seq, data))
    if held:
        yield *now, merged(held, *ends)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, found in _merged_ranges(batches):
        while held := list(islice(found, 4096)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), RUNS_ARROW)], schema=RUNS_ARROW)


def _merge_to_runs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for group, nth, found in _merged_ranges(batches):
        k = 0
        while held := list(islice(found, rows)):
            yield block(f"group-{group:09d}", nth << 24 | k, held)
            k += 1


def ranged(blocks: DataFrame, groups: int, rows: int) -> tuple[DataFrame, int]:
    """Rows (group, range, low, high, run, seq, data): each block once for each range that it reaches
    into; and the number of ranges. Ranges are cut from keys and counts of blocks, without their data."""
    group = F.pmod(F.xxhash64("run"), F.lit(groups)).cast("int").alias("group")
    index = blocks.select(group, "run", "seq", "n", "first", "last")
    # begins and ends of blocks in one order: the range of a place is that of the last begin up to it
    begins = index.select("group", "run", "seq", F.col("first").alias("key"), F.lit(0).alias("end"), "n")
    ends = index.select("group", "run", "seq", F.col("last").alias("key"), F.lit(1).alias("end"), F.lit(0).cast("long").alias("n"))
    events = stored(begins.union(ends), "warc-places")
    # all blocks are one group in the last pass: a long group is cut by its keys, running sums are carried
    order = ["key", "end", "run", "seq"]
    known = ordered.cuts(events, ["group"], order, ordered.LEAST)
    events = ordered.summed(events, ["group"], order, "n", "before", known)
    events = events.withColumn("begun", F.when(F.col("end") == 0, F.floor(F.col("before") / rows).cast("int")))
    events = stored(ordered.filled(events, ["group"], order, "begun", "range", known), "warc-places")
    lows = events.where("end = 0").groupBy("group", "range").agg(F.min("key").alias("low"))
    lows = stored(lows.withColumn("high", F.lead("low").over(Window.partitionBy("group").orderBy("range"))), "warc-ranges")
    reach = events.groupBy("run", "seq").agg(F.min("group").alias("group"), F.min("range").alias("a"), F.max("range").alias("b"))
    reach = reach.select("run", "seq", "group", F.explode(F.sequence("a", "b")).alias("range")).join(lows, ["group", "range"])
    found = blocks.select("run", "seq", "data").join(reach, ["run", "seq"])
    return found.select("group", "range", "low", "high", "run", "seq", "data"), lows.count()


def history(sorted_runs: DataFrame, fan_in: int = FAN_IN, range_rows: int = RANGE_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All captures in order of URL key, timestamp and id: partition after partition."""
    spark = sorted_runs.sparkSession
    while (groups := -(-sorted_runs.select("run").distinct().count() // fan_in)) > 1:
        units, _ = ranged(sorted_runs, groups, range_rows)
        merged = units.repartition("group", "range").sortWithinPartitions("group", "range").mapInArrow(partial(_merge_to_runs, rows=block_rows), BLOCKS)
        sorted_runs = stored(merged, "warc-runs", "uncompressed")
    units, ranges = ranged(sorted_runs, 1, range_rows)
    parts = max(1, min(ranges, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    place = F.floor(F.col("range") * F.lit(parts) / F.lit(max(1, ranges))).cast("int")
    return units.repartitionById(parts, place).sortWithinPartitions("range").mapInArrow(_merge, RUNS)


def captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Archives the pages, reads the archives back and merges their index."""
    found = history(runs(write(pages, id_col, url_col, html_col, None, min_bytes)))
    return found.select(F.col("page_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "timestamp")
