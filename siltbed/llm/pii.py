"""Offset-preserving detection of personal data, disguised forms included.

Base spans are found in the text itself by four fixed patterns. Then a cascade
of finite-state transducers rewrites the text: homoglyphs and full-width forms
to ASCII, spelled digits to digits, bracketed or spelled "at" and "dot" to the
signs. Each looks at the text that the one before it wrote; what it skips at a
quick look has nothing that its pattern could match. Each transducer keeps, for
every character it writes, the range of source characters it came from, so what
the same detectors find in the rewritten text maps back to source offsets. Of those spans, the ones that overlap a base span
of their kind are already known and go; the rest are added.

Rules that keep clean prose clean: a spelled "at" or "dot" counts only between
brackets, or as a whole word where a full address (name at host dot suffix) is
spelled; spelled digits count in runs of seven items or more, and shorter runs,
mixed with plain digits or not, where they complete a valid address, card or phone
number that nothing else gave; a span is added only if it holds a disguise, or it
would have been a base span.

The time grows with the length of a text, whatever it holds: names are looked for
from their signs leftward, and no part of a text is scanned from each of its places.

Defined results: null and empty texts have no spans; repeated rows repeat;
offsets are code points, ends exclusive; very long texts are read whole. Ties:
spans of equal starts follow the order of KINDS, then their ends; redaction takes
the first and skips what begins within it. Columns of the caller named like an
added one give way; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import without

#: The kinds in their order and the patterns of their base spans.
KINDS = ("email", "ip", "card", "phone")
#: Written so that each finds the same spans as [0-9]+(\.[0-9]+)... and the like in a
#: time that grows with the text: a number begins where no digit stands before it, and
#: runs give nothing back. The name before an email's sign is found from the sign.
PATTERNS = {
    "ip": re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
NAME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
#: What must occur for a pattern to match at all; faster to look for.
NEEDED = {
    "email": re.compile(r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]"),
    "ip": re.compile(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]"),
}
#: Letters of other scripts that look like ASCII ones.
HOMOGLYPHS = dict(zip(
    "аеорсухіјѕԁһԛԝӏАВЕКМНОРСТХІЈЅ" "αορνικυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "ɡıⅼ" "‐‑‒–−" "․。．" "＠﹫" "＋" "٠١٢٣٤٥٦٧٨٩" "۰۱۲۳۴۵۶۷۸۹",
    "aeopcyxijsdhqwlABEKMHOPCTXIJS" "aopvikuxABEZHIKMNOPTYX" "gil" "-----" "..." "@@" "+" "0123456789" "0123456789",
))
#: Number words in the languages of the corpus.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
SPELLED_LEAST = 7
_WORD = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
_ITEM = rf"(?:\b{_WORD}\b|[0-9]+|\b(?:plus|dot|point|dash)\b)"
SPELLED_RUN = re.compile(rf"(?:\b(?:plus)[\x20-]+)?\b{_WORD}\b(?:[\x20,.()-]{{1,3}}{_ITEM}){{{SPELLED_LEAST - 1},}}", re.I)
SPELLED_ITEM = re.compile(rf"\b({_WORD})\b|\b(plus)\b|\b(dot|point)\b|\bdash\b|[0-9]+|[\x20,.()-]+", re.I)
BRACKETED = re.compile(r"(?:\(\s*(at|dot|punto|punkt|point)\s*\)|\[\s*(at|dot|punto|punkt|point)\s*\]|\{\s*(at|dot|punto|punkt|point)\s*\}|<\s*(at|dot)\s*>|\(\s*[@]\s*\)|\[\s*[@]\s*\]|\(\s*\.\s*\)|\[\s*\.\s*\]|&#64;|&commat;|%40|&#46;|&period;|%2e)[\x20]*", re.I)
UNDERSCORED_NAME = NAME.replace("_", "").replace("%", "") + "_"
UNDERSCORED = re.compile(r"_at_[A-Za-z0-9-]+(?:_dot_[A-Za-z0-9-]+)+", re.I)
DOTTED_NUMBERS = re.compile(r"\b[0-9]{1,3}(?:\x20dot\x20[0-9]{1,3}){3}\b", re.I)
SPACED_AT = re.compile(r"(?<=[A-Za-z0-9])\x20@\x20(?=[A-Za-z0-9-]+\.[A-Za-z0-9-])")
AT_SIGNS = ("@", "&#64;", "&commat;", "%40")
#: A spelled address, found from its sign: what follows the sign, and, read from right to left, the name before it.
SPELLED_SIGN = re.compile(r"\x20(?=at\x20)|\x20?@", re.I)
SPELLED_HOST = re.compile(r"(?:\x20at\x20|\x20?@\x20?)(?:[A-Za-z0-9-]+(?:(?:\.|\x20dot\x20)[A-Za-z0-9-]+)*(?:\x20dot\x20)[A-Za-z]{2,}|[A-Za-z0-9-]+(?:\x20dot\x20[A-Za-z0-9-]+)+)\b", re.I)
SPELLED_NAME = re.compile(r"[A-Za-z0-9_%+-]++(?:(?:\.|\x20dot\x20)[A-Za-z0-9_%+-]++)*", re.I)
SPELLED_EMAN = re.compile(r"[A-Za-z0-9_%+-]++(?:(?:\.|\x20tod\x20)[A-Za-z0-9_%+-]++)*", re.I)
NAME_BEGINS = re.compile(r"\b[A-Za-z0-9_%+-]", re.I)
SIGNS = re.compile(r"\x20dot\x20|\x20at\x20|\x20?@\x20?", re.I)
UNDERSCORED_SIGNS = re.compile(r"_at_|_dot_", re.I)
#: Spelled and plain digits mixed, two items or more.
MIXED_RUN = re.compile(rf"(?:\bplus[\x20,.()-]+|\+[\x20(]*)?(?:\b{_WORD}\b|\b[0-9]+)(?:[\x20,.()-]{{1,3}}{_ITEM})+", re.I)
#: Quick looks, each implied by the patterns it stands before.
ODD_LETTER = re.compile(rf"[{re.escape(''.join(HOMOGLYPHS))}\uff01-\uff5e\u200b-\u200d\u2060\ufeff\u00ad]")
ODD_SIGN = re.compile(r"[(\[{<]\s*(?:at|dot|punto|punkt|point|@|\.)\s*[)\]}>]|&#64;|&commat;|%40|&#46;|&period;|%2e", re.I)
ODD_DIGITS = re.compile(rf"\b{_WORD}\b[\x20,.()-]{{1,3}}{_ITEM}|(?:\b[0-9]+|\b(?:plus|dot|point|dash)\b)[\x20,.()-]{{1,3}}{_WORD}\b", re.I)
LONE_WORD = re.compile(rf"\b{_WORD}\b", re.I)
TOKEN = re.compile(r"\w+")
ZERO_WIDTH = dict.fromkeys("\u200b\u200c\u200d\u2060\ufeff\u00ad", "")


def digit(word: str) -> str:
    """The digit of a number word; letters that only ignored case equates with s and i count as these."""
    return DIGIT_WORDS[word.replace("\u017f", "s").replace("\u0130", "i").replace("\u0131", "i").lower()]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p) < 4 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in found.split(".")))
    if kind == "card":
        digits = found.replace(" ", "").replace("-", "")
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= sum("0" <= c <= "9" for c in found) <= 15
    return True


def run_before(text: str, low: int, at: int, letters: str) -> int:
    """Where the run of these letters that ends at `at` begins, `low` at least."""
    return low + len(text[low:at].rstrip(letters))


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of name@host.suffix."""
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        # no name holds an @, so what lies before this one is looked at once
        start, m = run_before(text, low, at, NAME), HOST.match(text, at)
        low = at + 1
        if m and start < at:
            out.append((start, m.end()))
            low = m.end()
        at = text.find("@", low)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end), sorted: leftmost matches, failing ones dropped."""
    out = []
    for k, kind in enumerate(KINDS):
        if NEEDED[kind].search(text):
            if kind == "email":
                out += [(a, k, b) for a, b in emails(text)]
            else:
                out += [(m.start(), k, m.end()) for m in PATTERNS[kind].finditer(text) if _valid(kind, m[0])]
    return sorted(out)


class Tape:
    """A rewritten text; character i came from source characters start[i] to end[i]."""

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None):
        self.text = text
        # None: each character came from its own place
        self.start, self.end = start, end

    def source(self, a: int, b: int) -> tuple[int, int]:
        """The source range of characters a to b."""
        return (a, b) if self.start is None else (int(self.start[a]), int(self.end[b - 1]))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Tape:
        """Replaces disjoint ranges, in order; what is written spans its whole range."""
        if not edits:
            return self
        n = len(self.text)
        starts = np.arange(n) if self.start is None else self.start
        ends = np.arange(1, n + 1) if self.end is None else self.end
        low, high, size = (np.array(x, np.int64) for x in zip(*((a, b, len(new)) for a, b, new in edits)))
        # places of the old text that stay, and where in the new one they and the edits go
        held = np.ones(n + 1, np.int64)
        np.add.at(held, low, -1)
        np.add.at(held, high, 1)
        stays = np.flatnonzero((np.cumsum(held) - np.arange(1, n + 2) == 0)[:n])
        shift = np.cumsum(size - (high - low))
        to = stays + np.r_[0, shift][np.searchsorted(low, stays, side="right")]
        new_at = low + np.r_[0, shift[:-1]]
        start, end = (np.empty(n + int(shift[-1]), np.int64) for _ in range(2))
        start[to], end[to] = starts[stays], ends[stays]
        at = np.repeat(new_at - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        start[at], end[at] = np.repeat(starts[low], size), np.repeat(ends[high - 1], size)
        text, done = [], 0
        for a, b, new in edits:
            text += [self.text[done:a], new]
            done = b
        return Tape("".join([*text, self.text[done:]]), start, end)


def _letter(c: str) -> str:
    if c in HOMOGLYPHS:
        return HOMOGLYPHS[c]
    if c in ZERO_WIDTH:
        return ""
    if "\uff01" <= c <= "\uff5e":
        return unicodedata.normalize("NFKC", c)
    return c


def homoglyphs(tape: Tape) -> Tape:
    if tape.text.isascii() or not ODD_LETTER.search(tape.text):
        return tape
    return tape.rewrite([(i, i + 1, new) for i, c in enumerate(tape.text) if c > "\x7f" and (new := _letter(c)) != c])


def numbers(text: str) -> bool:
    """Whether a number word stands beside another part of a number; every run has such a pair."""
    low = text.lower()
    plain = text.isascii() or not any(c in text for c in "\u017f\u0130\u0131")  # case may equate these with s and i
    return not (plain and DIGIT_WORDS.keys().isdisjoint(TOKEN.findall(low))) and bool(ODD_DIGITS.search(text))


def spelled_digits(tape: Tape, run: re.Pattern[str] = SPELLED_RUN) -> Tape:
    edits = []
    for m in run.finditer(tape.text):
        if run is MIXED_RUN and not LONE_WORD.search(m[0]):
            continue  # plain digits are no disguise
        for x in SPELLED_ITEM.finditer(tape.text, m.start(), m.end()):
            new = digit(x[1]) if x[1] else "+" if x[2] else "." if x[3] else x[0] if x[0][0] in "0123456789" else ""
            edits.append((x.start(), x.end(), new))
    return tape.rewrite(edits)


def spelled_addresses(text: str) -> Iterator[tuple[int, int]]:
    """Addresses with a spelled sign or dot, from their signs; a name is looked for up to the sign before."""
    low = seen = 0
    for sign in SPELLED_SIGN.finditer(text):
        at = sign.start()
        if at < low or not (host := SPELLED_HOST.match(text, at)):
            seen = max(seen, at + 1)
            continue
        chain = SPELLED_EMAN.match(text[max(low, seen) : at][::-1])
        seen = max(seen, at + 1)
        start = NAME_BEGINS.search(text, at - chain.end(), at) if chain else None
        while start and not SPELLED_NAME.fullmatch(text, start.start(), at):
            start = NAME_BEGINS.search(text, start.start() + 1, at)
        if start:
            yield start.start(), host.end()
            low = host.end()


def underscored_addresses(text: str) -> Iterator[tuple[int, int]]:
    low = 0
    for m in UNDERSCORED.finditer(text):
        start = run_before(text, low, m.start(), UNDERSCORED_NAME)
        if start < m.start() and not (start and text[start - 1].isascii() and text[start - 1].isalnum()):
            yield start, m.end()
        low = m.end()


def found_by(pattern: re.Pattern[str], text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in pattern.finditer(text))


def signs(tape: Tape) -> Tape:
    edits, done = [], 0
    for m in BRACKETED.finditer(tape.text) if ODD_SIGN.search(tape.text) else ():
        word = next((g for g in m.groups() if g), "@" if any(x in m[0].lower() for x in AT_SIGNS) else ".").lower()
        edits.append((run_before(tape.text, done, m.start(), " "), m.end(), "@" if word in ("at", "@") else "."))
        done = m.end()
    tape = tape.rewrite(edits)
    for find, inner, must in (
        (spelled_addresses, SIGNS, " dot "),
        (partial(found_by, DOTTED_NUMBERS), SIGNS, " dot "),
        (underscored_addresses, UNDERSCORED_SIGNS, "_at_"),
        (partial(found_by, SPACED_AT), SIGNS, " @ "),
    ):
        if must not in tape.text.lower():
            continue
        edits = []
        for a, b in find(tape.text):
            edits += [(x.start(), x.end(), "." if "dot" in x[0].lower() else "@") for x in inner.finditer(tape.text, a, b)]
        tape = tape.rewrite(edits)
    return tape


class Known:
    """Spans of one kind, to ask whether another overlaps one of them."""

    def __init__(self, found: list[tuple[int, int]]):
        self.starts = [a for a, _ in found]
        self.ends = list(accumulate((b for _, b in found), max))

    def meets(self, a: int, b: int) -> bool:
        k = bisect_left(self.starts, b)
        return k > 0 and self.ends[k - 1] > a


def spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and base and added spans, as (start, kind, end), both sorted."""
    base = base_spans(text)
    letters = homoglyphs(Tape(text))
    every = set(base)
    for run in (SPELLED_RUN, MIXED_RUN) if numbers(letters.text) else (None,):
        known, tape = list(every) if run is MIXED_RUN else base, signs(spelled_digits(letters, run) if run else letters)
        if tape.start is None:
            continue
        kinds = [Known(sorted((x, y) for x, kind, y in known if kind == k)) for k in range(len(KINDS))]
        for a, k, b in base_spans(tape.text):
            if run is MIXED_RUN and KINDS[k] == "email":
                continue
            start, end = tape.source(a, b)
            if text[start:end] != tape.text[a:b] and not kinds[k].meets(start, end):
                every.add((start, k, end))
    return base, sorted(every)


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def redact(text: str | None) -> str | None:
    """The text with each span, disguised ones included, replaced by its kind in brackets."""
    if not text:
        return text
    out, at = [], 0
    for a, k, b in spans(text)[1]:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def _detect(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts, base_text, all_text = [[] for _ in KINDS], [], []
        for text in b.column(b.num_columns - 1).to_pylist():
            base, every = spans(text or "")
            for k, c in enumerate(counts):
                c.append(sum(x[1] == k for x in base))
            base_text.append(joined(base))
            all_text.append(joined(every))
        new = [*(pa.array(c, pa.int64()) for c in counts), pa.array(base_text, pa.string()), pa.array(all_text, pa.string())]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], *new], names)


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(map(redact, b.column(b.num_columns - 1).to_pylist()), pa.string(), size=b.num_rows)], b.schema.names)


FOUND = [*(f"n_{k}" for k in KINDS), "base_spans", "spans"]


def detect(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all but the text if None), counts of base spans by kind, base_spans and spans.

    Spans are kind:start:end, joined by commas. Columns with these names give way.
    """
    held = [F.col(f"`{c}`") for c in keep] if keep is not None else without(docs, text_col, *FOUND)
    rows = docs.select(*held, F.col(f"`{text_col}`").alias("_text"))
    new = [T.StructField(n, T.LongType() if n.startswith("n_") else T.StringType()) for n in FOUND]
    kind = T.StructType([*rows.schema.fields[:-1], *new])
    return rows.mapInArrow(partial(_detect, names=kind.names), kind)


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the spans of the text replaced; rows, columns and their order as given."""
    rows = docs.select(*without(docs, text_col), F.col(f"`{text_col}`"))
    return rows.mapInArrow(_redact, rows.schema).select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts of base spans, the digest of the base spans, and all spans."""
    found = detect(docs, text_col, [id_col])
    return found.select(F.col(f"`{id_col}`"), *[f"n_{k}" for k in KINDS], F.sha2("base_spans", 256).alias("base_sha256"), "spans")
