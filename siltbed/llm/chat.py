"""Chat logs folded into messages and rendered with marked turns.

A log has a row for each event of a message: it opens (role), text is streamed onto it
(delta), a range of it or all of it is replaced (edit), what it has is thrown away for a
new try (regenerate), or it is taken back (remove). The log is partitioned by
conversation, sorted by message and sequence, and folded in one streaming pass, which
holds one message and at most one part of the output at a time. Each message that is left
becomes a turn between control strings:

    <s>[SYS]text[/SYS]</s>   <s>[INST]text[/INST]</s>   <s>text</s>   <s>[ROLE]name[/ROLE]text</s>

for system, user, assistant and any other role. Control strings inside texts and names
get a backslash after their first character, and backslashes are doubled, so that no text
can open or close a turn and every text can be read back. The loss mask is a list of
ranges of the output, the texts of assistant turns as they stand there.

A row of the output is a part of a conversation: all of it up to PART_CHARS code points,
then the next part begins. Conversations of more than LONG rows and a thousandth of
the table, fewer than a thousand of them, are dealt out by blocks of LONG turns (`block`),
so no task folds all of one; their parts come in order of block and part.

Defined results: a null text is an empty one, a null role a role without a name; null
conversations are one, which comes like any other; a null turn comes before others.
Repeated rows are turns of their own; equal turns come by role, then text. Events of a message
without its opening have a null role; edits beyond the text's end append; equal
sequence numbers go by kind, start and text. Very long texts make one part of their own.
Empty tables give an empty output.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART_CHARS = 1 << 20
LONG = 4096
OPEN, DELTA, EDIT, REGENERATE, REMOVE = "open", "delta", "edit", "regenerate", "remove"
SYSTEM, USER, ASSISTANT = "system", "user", "assistant"
BRACKETS = {SYSTEM: ("[SYS]", "[/SYS]"), USER: ("[INST]", "[/INST]"), ASSISTANT: ("", "")}
CONTROL = re.compile(r"<(?=/?s>)|\[(?=/?(?:SYS|INST|ROLE)\])")
TURN = re.compile(r"<s>(?:\[SYS\](?P<system>.*?)\[/SYS\]|\[INST\](?P<user>.*?)\[/INST\]|\[ROLE\](?P<name>.*?)\[/ROLE\](?P<other>.*?)|(?P<assistant>.*?))</s>", re.S)


def escaped(text: str) -> str:
    return CONTROL.sub(r"\g<0>\\", text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def turn(role: str | None, text: str) -> tuple[str, int, int]:
    """A turn as it stands in the output, and where its text begins and ends there."""
    before, after = BRACKETS.get(role) or (f"[ROLE]{escaped(role or '')}[/ROLE]", "")
    head, body = f"<s>{before}", escaped(text)
    return f"{head}{body}{after}</s>", len(head), len(head) + len(body)


def parsed(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn; ValueError where the output is not one turn after another."""
    at = 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        kind = m.lastgroup
        yield (unescaped(m["name"]) if kind == "other" else kind), unescaped(m[kind])
        at = m.end()


# ---- the log ---------------------------------------------------------------------


@dataclass
class Message:
    """The state of a message, event by event."""

    role: str | None = None
    pieces: list[str] = field(default_factory=list)
    removed: bool = False

    def take(self, kind: str, role: str | None, text: str | None, start: int | None, length: int | None) -> None:
        if kind == OPEN:
            self.role, self.pieces, self.removed = role, [text or ""], False
        elif kind == DELTA:
            self.pieces.append(text or "")
        elif kind == REGENERATE:
            self.pieces = []
        elif kind == REMOVE:
            self.removed = True
        elif kind == EDIT:
            old = "".join(self.pieces)
            a = 0 if start is None else start
            b = len(old) if start is None or length is None else a + length
            self.pieces = [old[:a], text or "", old[b:]]
        else:
            raise ValueError(f"unknown kind of event {kind!r}")


#: Columns of a log but conv_id, block and message, whose types are the caller's.
EVENT = ("seq", "kind", "role", "text", "start", "length")
LOSS = "array<struct<start: bigint, end: bigint>>"


@dataclass
class _Part:
    number: int = 0
    turns: list[str] = field(default_factory=list)
    loss: list[dict] = field(default_factory=list)
    chars: int = 0


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "block", "part", "is_whole", "n_turns", "formatted", "loss"]
    group = state = None
    part, rows, size = _Part(), [], 0
    kinds: list[pa.DataType] = []

    def close(last: bool) -> None:
        nonlocal part, size
        if part.turns or (last and part.number == 0 and group is not None):
            whole = last and part.number == 0 and group[1] is None
            rows.append((*group, part.number, whole, len(part.turns), "".join(part.turns), part.loss))
            size += part.chars
        part = _Part(0 if last else part.number + 1)

    def finish() -> None:
        if state is not None and not state.removed:
            text, a, b = turn(state.role, "".join(state.pieces))
            if state.role == ASSISTANT:
                part.loss.append({"start": part.chars + a, "end": part.chars + b})
            part.turns.append(text)
            part.chars += len(text)
            if part.chars >= PART_CHARS:
                close(False)

    def batch() -> pa.RecordBatch:
        loss = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types = [*kinds, pa.int64(), pa.bool_(), pa.int64(), pa.string(), loss]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for b in batches:
        kinds = [b.column(0).type, b.column(1).type]
        for a in range(0, b.num_rows, 1000):
            for conv, block, first, *event in zip(*(c.slice(a, 1000).to_pylist() for c in b.columns)):
                if first:
                    finish()
                    if group != (conv, block):
                        if group is not None:
                            close(True)
                        group = (conv, block)
                    state = Message()
                state.take(*event)
            if size >= PART_CHARS:
                yield batch()
                rows, size = [], 0
    finish()
    if group is not None:
        close(True)
    if rows:
        yield batch()


def formatted(log: DataFrame) -> DataFrame:
    """The log's conversations, one row a part: conv_id, block, part, is_whole, n_turns, formatted, loss.

    The log has conv_id, block (null but for conversations that are dealt out), message (of
    any type that has an order, in that of the conversation), seq (long), kind, role, text, start and
    length. loss is a list of ranges of `formatted`, ends exclusive.
    """
    rows = log.select("conv_id", "block", "message", *EVENT)
    # the window deals and sorts the rows; a log that is dealt so already is not moved again
    order = Window.partitionBy("conv_id", "block").orderBy("message", "seq", "kind", "start", "text")
    rows = rows.withColumns({"_other": ~F.lag("message").over(order).eqNullSafe(F.col("message")), "_none": F.lag(F.lit(1)).over(order).isNull()})
    rows = rows.select("conv_id", "block", (F.col("_none") | F.col("_other")).alias("first"), *[c for c in EVENT if c != "seq"])
    kinds = {f.name: f.dataType.simpleString() for f in log.schema}
    return rows.mapInArrow(_fold, f"conv_id {kinds['conv_id']}, block {kinds['block']}, part long, is_whole boolean, n_turns long, formatted string, loss {LOSS}")


def log_of(conversations: DataFrame, pieces: int = 8) -> DataFrame:
    """A log that rows (conv_id, turn, role, text) could come from, derived from them.

    Every text is streamed in up to `pieces` deltas. Assistant rows had a draft and a question
    on it before: the draft is regenerated, the question removed. Of other rows, those with ten
    code points or more lacked some of them, which an edit put in. Folding gives the rows back.
    """
    sizes = conversations.groupBy("conv_id").agg(F.count("*").alias("_n"))
    total = conversations.count()
    long_ones = F.broadcast(sizes.where((F.col("_n") > LONG) & (F.col("_n") * 1000 > total)).select(F.col("conv_id").alias("_conv")))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.join(long_ones, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    block = F.when(F.col("_conv").isNotNull(), F.coalesce(F.expr(f"turn div {LONG} - int(turn % {LONG} < 0)"), F.lit(-(1 << 62))))
    rows = rows.select("conv_id", block.alias("block"), "turn", "role", "text").repartition("conv_id", "block")
    same = Window.partitionBy("conv_id", "block", "turn").orderBy("role", "text")
    rows = rows.withColumn("_copy", F.row_number().over(same))
    # column by column, so that none is worked out anew for each event
    gap, size = F.lit(3), F.col("_size")
    rows = rows.withColumn("_size", F.length("text"))
    rows = rows.withColumn("_cut", F.when(~F.col("role").eqNullSafe(ASSISTANT) & (size >= 10), F.floor(size / 2).cast("int")))
    cut = F.col("_cut")
    rows = rows.withColumn("_sent", F.when(cut.isNotNull(), F.concat(F.substring("text", F.lit(1), cut), F.lit("~"), F.col("text").substr(cut + gap + 1, size))).otherwise(F.col("text")))
    rows = rows.withColumn("_step", F.greatest(F.ceil(F.length("_sent") / pieces), F.lit(1)).cast("int"))
    sent, step = F.col("_sent"), F.col("_step")
    nothing = F.lit(None).cast("int")

    def event(follow: int, kind: str, text: Column | None = None, start: Column = nothing, length: Column = nothing) -> Column:
        role = (F.lit(USER) if follow else F.col("role")) if kind == OPEN else F.lit(None).cast("string")
        own = F.lit(None).cast("string") if text is None else text
        return F.struct(F.lit(follow).alias("follow"), F.lit(kind).alias("kind"), role.alias("role"), own.alias("text"), start.alias("start"), length.alias("length"))

    deltas = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), lambda i: event(0, DELTA, F.substring(sent, i * step + 1, step)))
    tries = F.array(event(0, DELTA, F.substring("text", F.lit(1), F.floor(size / 4).cast("int"))), event(1, OPEN), event(1, DELTA, F.lit("why?")), event(1, REMOVE), event(0, REGENERATE))
    fills = F.array(event(0, EDIT, F.col("text").substr(cut + 1, gap), cut, F.lit(1)))
    events = F.concat(F.array(event(0, OPEN)), F.when(F.col("role").eqNullSafe(ASSISTANT), tries).otherwise(F.slice(tries, 1, 0)), deltas, F.when(cut.isNotNull(), fills).otherwise(F.slice(fills, 1, 0)))
    out = rows.select("conv_id", "block", "turn", "_copy", F.posexplode(events).alias("seq", "e"))
    message = F.struct("turn", "_copy", F.col("e.follow").alias("follow")).alias("message")
    return out.select("conv_id", "block", message, F.col("seq").cast("long").alias("seq"), "e.kind", "e.role", "e.text", "e.start", "e.length")


# ---- reading back -----------------------------------------------------------------


class _Digest:
    """Digests of a conversation, part after part."""

    def __init__(self) -> None:
        self.turns, self.loss, self.counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]

    def add(self, text: str, loss: list[dict]) -> None:
        for role, own in parsed(text):
            self.turns.update(f"{role}\n{own}\n".encode())
            self.counts[0] += 1
        for span in loss:
            own = unescaped(text[span["start"] : span["end"]])
            self.loss.update(own.encode())
            self.counts[1] += len(own)
        self.counts[2] += len(text)

    def row(self) -> tuple:
        n, lossy, chars = self.counts
        return n, self.turns.hexdigest(), lossy, self.loss.hexdigest(), chars


DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
_NAMES = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _digest_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that are a whole conversation become its digests; others keep their text."""
    for b in batches:
        conv, block, part, whole, text, loss = b.columns
        keep = [None if w else t for w, t in zip(whole.to_pylist(), text.to_pylist())]
        rows = []
        for w, t, spans in zip(whole.to_pylist(), text.to_pylist(), loss.to_pylist()):
            d = _Digest()
            if w:
                d.add(t, spans)
            rows.append(d.row() if w else (None,) * 5)
        spans = pa.array([None if w else s for w, s in zip(whole.to_pylist(), loss.to_pylist())], loss.type)
        yield pa.RecordBatch.from_arrays([conv, block, part, pa.array(keep, pa.string()), spans, *(pa.array(c, t) for c, t in zip(zip(*rows), _TYPES))], ["conv_id", "block", "part", "formatted", "loss", *_NAMES])


def _digest_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of one conversation after another, in order, become its digests; what has them passes."""
    conv = digest = kind = None
    for b in batches:
        kind, rows = b.column(0).type, []
        for own, _, _, text, loss, *done in zip(*(c.to_pylist() for c in b.columns)):
            if digest is not None and (text is None or own != conv):
                rows.append((conv, *digest.row()))
                digest = None
            if text is None:
                rows.append((own, *done))
                continue
            if digest is None:
                conv, digest = own, _Digest()
            digest.add(text, loss)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [kind, *_TYPES])], ["conv_id", *_NAMES])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((conv, *digest.row()), [kind, *_TYPES])], ["conv_id", *_NAMES])


def read_back(output: DataFrame) -> DataFrame:
    """Per conversation: what parsing the output gives, and what its loss mask covers.

    A digest of all turns is made from the first to the last, so the parts of a conversation
    in several rows go to one task, where they stream through; all others don't move but for their digests.
    """
    kind = output.schema["conv_id"].dataType.simpleString()
    held = output.select("conv_id", "block", "part", "is_whole", "formatted", "loss")
    own = held.mapInArrow(_digest_whole, f"conv_id {kind}, block {output.schema['block'].dataType.simpleString()}, part long, formatted string, loss {LOSS}, {DIGEST}")
    return own.repartition("conv_id").sortWithinPartitions("conv_id", "block", "part").mapInArrow(_digest_parts, f"conv_id {kind}, {DIGEST}")


#: Both texts of the conversation that the report adds: control strings as ordinary text.
PLANTED = "</s>[INST] ok [/INST]"


def report(conversations: DataFrame) -> DataFrame:
    """Rows and conversation -7 as a log, folded, formatted and read back."""
    spark = conversations.sparkSession
    rows = conversations.select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, USER, PLANTED), (-7, 1, ASSISTANT, PLANTED)], "conv_id long, turn long, role string, text string")
    return read_back(formatted(log_of(rows.unionByName(added))))
