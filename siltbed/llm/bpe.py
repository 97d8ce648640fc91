"""Byte-level BPE encoding and decoding by batched merge rounds in numpy.

The pre-tokenizer's pattern cuts a slice of documents into words, and Arrow tells
the distinct ones apart. Those not met before merge together: their symbols lie
in one flat array, a pair's rank is found by binary search over the sorted pair
keys, and in each round every word merges all its occurrences of its
lowest-ranked pair. Ids of words are kept per Python worker: beyond `KEPT` words a
new generation begins, which takes what it meets again from the one before, and that
one's predecessor goes; memory is bounded, results do not change. A text of over
`SLICE_CHARS` code points is cut where words always end, and its parts follow
one another.

Ties: a pair's rank is its place in the file, and of equal pairs in a word the
leftmost merges first. Defined results: null and empty texts have no ids; repeated rows repeat; columns of the caller named like an added one give way; an
added token's string in a text is that token, as in the tokenizers library; ids
of no token, and nulls, decode to nothing; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from itertools import chain
from unicodedata import category

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from siltbed.llm.common import without

#: Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEPT, LIBRARY_KEPT = 100_000, 500_000
SLICE_CHARS, SLICE_ROWS = 1 << 20, 512
LONGEST_KEPT, TOGETHER = 64, 512
NO_RANK = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    shown = set(plain)
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions of runs of these lengths from these starts, end to end."""
    ends = np.cumsum(length)
    out = np.repeat((start - (ends - length)).astype(start.dtype), length)
    out += np.arange(len(out), dtype=start.dtype)
    return out


class Bpe:
    """Encoder and decoder of one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.base = 1 + max(vocab.values())
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in merges], np.int64)
        del spec
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.arange(len(keys), dtype=np.int32)[order]
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)[order]
        self.byte_ids = np.array([vocab[c] for c in letters], np.int32)
        self.token_bytes = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items() if all(c in byte_of for c in t)}
        self.token_bytes |= {i: t.encode() for t, i in added.items()}
        tokens = [self.token_bytes.get(i, b"") for i in range(1 + max(self.token_bytes))]
        self.token_length = np.array([*map(len, tokens), 0], np.int64)
        self.token_start = (np.cumsum(self.token_length) - self.token_length).astype(np.int32)
        self.token_flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.pool = Pool(self.merge, added)

    def rank(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of the pairs that begin at these positions, NO_RANK if none."""
        nxt = np.minimum(at + 1, len(sym) - 1)
        key = sym[at].astype(np.int64) * self.base + sym[nxt]
        pos = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ok = (self.keys[pos] == key) & (word[at] == word[nxt]) & (nxt > at)
        return np.where(ok, self.ranks[pos], NO_RANK), self.made[pos]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the words, and how many each has."""
        raw = [w.encode("utf-8") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        sym = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, made = self.rank(sym, word, np.arange(len(sym))) if len(sym) else (np.empty(0, np.int32), np.empty(0, np.int32))
        while len(sym):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(sym)]))
            live = low != NO_RANK
            if not live.all():
                done.append((word[~live], sym[~live]))
                word, sym, rank, made, low = word[live], sym[live], rank[live], made[live], low[live]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == low)
            # where a pair overlaps itself, every second one of the run merges
            breaks = np.r_[True, np.diff(at) != 1]
            run = at[np.flatnonzero(breaks)][np.cumsum(breaks) - 1]
            at = at[(at - run) % 2 == 0]
            sym[at] = made[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            now = (np.cumsum(keep) - 1)[at]
            word, sym, rank, made = word[keep], sym[keep], rank[keep], made[keep]
            touched = np.zeros(len(sym), bool)
            touched[now] = touched[np.maximum(now - 1, 0)] = True
            again = np.flatnonzero(touched)
            rank[again], made[again] = self.rank(sym, word, again)
        if not done:
            return np.empty(0, np.int32), np.zeros(len(words), np.int64)
        word, sym = np.concatenate([w for w, _ in done]), np.concatenate([s for _, s in done])
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(words))

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and how many each has."""
        return self.pool.encode_batch(texts)

    def decode_batch(self, lists: pa.ListArray) -> pa.Array:
        """The text of each row's ids; of a null row the empty one."""
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
        none = len(self.token_length) - 1
        ids = np.where((ids >= 0) & (ids < none), ids, none)
        length = self.token_length[ids]
        start = self.token_start[ids]
        flat = self.token_flat[spread(start if length.sum() < 1 << 31 else start.astype(np.int64), length)]
        ends = np.r_[0, np.cumsum(length)][np.r_[0, np.cumsum(counts)]]
        data = memoryview(flat)
        if len(data) < 1 << 31 and valid(data, flat, ends):
            return pa.StringArray.from_buffers(len(counts), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat))
        return pa.array([str(data[a:b], "utf-8", "replace") for a, b in zip(ends, ends[1:])], pa.string())


def valid(data: memoryview, flat: np.ndarray, ends: np.ndarray) -> bool:
    """Whether each stretch between ends is UTF-8: all of it is, and no character lies across an end."""
    try:
        str(data, "utf-8")
    except UnicodeDecodeError:
        return False
    inner = ends[ends < len(flat)]
    return not ((flat[inner] & 0xC0) == 0x80).any()


def latin1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Splitter:
    """Cuts a text into the pre-tokenizer's words."""

    def __init__(self):
        # the same words, and the commonest kind is tried first: it begins otherwise than the contractions before it
        contractions, letters, rest = PATTERN.partition(r" ?\p{L}+|")
        quick = letters + "'(?:[stmd]|re|ve|ll)|" + rest
        self.words = regex.compile(quick)
        self.library = ByteLevel(add_prefix_space=False)
        # the same pattern with the classes spelled out for Latin-1, which the plain engine runs twice as fast
        letters, numbers = ("".join(re.escape(c) for c in map(chr, range(256)) if category(c)[0] == k) for k in "LN")
        spaces = r" \t-\r\x85\xa0"
        spelled = quick.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]").replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
        self.latin = re.compile(spelled.replace(r"\s", f"[{spaces}]").replace(r"\S", f"[^{spaces}]"))

    def __call__(self, text: str) -> list[str]:
        """Unicode versions differ on letters added of late: of texts with characters
        that Python's does not know, the library's splitter decides."""
        if latin1(text):
            return self.latin.findall(text)
        if max(text) < "\u0378" or not any(category(c) == "Cn" for c in text):
            return self.words.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]


class Pool:
    """Ids of the words met of late, in one flat array; two generations of about `kept` words, KEPT if None.

    learn: words to their flat ids, and how many each has.
    """

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], added: dict[str, int], kept: int | None = None):
        self.learn, self.added, self.split, self.kept = learn, added, Splitter(), kept
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.gap = re.compile(r" (?=\S)")
        self.forget()

    def forget(self) -> None:
        self.renew()
        self.old = ({}, self.flat, self.start, self.length)

    def renew(self) -> None:
        """Begins a generation."""
        if hasattr(self, "codes"):
            self.old = (self.codes, self.flat, self.start, self.length)
        self.codes: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.int32)
        self.start, self.length = np.empty(0, np.int64), np.empty(0, np.int64)
        self.used = 0

    def _learn(self, words: list[str]) -> None:
        codes, flat, start, length = self.old
        again = [(w, c) for w in words if (c := codes.get(w)) is not None] if codes else []
        fresh = [w for w in words if w not in codes] if again else words
        at = np.array([c for _, c in again], np.int64)
        parts = [(flat[spread(start[at], length[at])], length[at])] if again else []
        parts += [self.learn(fresh)] if fresh else []
        words = [*(w for w, _ in again), *fresh]
        flat, length = (np.concatenate(x) for x in zip(*parts))
        self.codes.update(zip(words, range(len(self.start), len(self.start) + len(words))))
        self.start = np.concatenate([self.start, self.used + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.used += len(flat)

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.codes) > (self.kept or KEPT):
            self.renew()
        split = [self.split(t) for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        words = list(chain.from_iterable(split))
        del split
        # Arrow tells words apart, so that each distinct one is looked up once
        nth = pa.array(words, pa.large_string()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        first = np.empty(nth.max(initial=-1) + 1, np.int64)
        first[nth[::-1]] = np.arange(len(words))[::-1]
        known = [words[i] for i in first.tolist()]
        place = list(map(self.codes.get, known))
        new = [w for w, p in zip(known, place) if p is None]
        if new:
            self._learn(new)
            place = [self.codes[w] if p is None else p for w, p in zip(known, place)]
        codes = np.array(place, np.int64)[nth]
        for w in [w for w in new if len(w) > LONGEST_KEPT]:
            del self.codes[w]
        length = self.length[codes]
        per_text = np.diff(np.r_[0, np.cumsum(length)][np.r_[0, np.cumsum(sizes)]])
        return self.flat[spread(self.start[codes], length)], per_text

    def stretches(self, text: str) -> list[str]:
        """A long text, cut where words always end: before a space that a non-space follows."""
        out, at = [], 0
        while len(text) - at > SLICE_CHARS and (m := self.gap.search(text, at + SLICE_CHARS)):
            out.append(text[at : m.start()])
            at = m.start()
        return [*out, text[at:]]

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and how many each has."""
        if max(map(len, texts), default=0) <= SLICE_CHARS and (self.cut is None or not any(t in x for x in texts for t in self.added)):
            return self._plain(texts)
        flat, counts = [np.empty(0, np.int32)], []
        for x in texts:
            n = 0
            for part in self.cut.split(x) if self.cut else [x]:
                for y in [] if part in self.added else self.stretches(part):
                    flat.append(self._plain([y])[0])
                    n += len(flat[-1])
                if part in self.added:
                    flat.append(np.array([self.added[part]], np.int32))
                    n += 1
            counts.append(n)
        return np.concatenate(flat), np.array(counts, np.int64)


def library_pool(path: str) -> Pool:
    """A pool whose words the tokenizers library encodes, each distinct one once.

    Words that are a space and letters go to it many at a time, end to end: it cuts them
    apart again where each begins, which is where a token has the space's letter. Where these are
    not as many as the words that were given (letters of another Unicode version), and all
    other words, it gets one by one.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    space = byte_letters()[0x20]
    begins = np.zeros(1 + max(library.get_vocab().values()), bool)
    begins[[i for t, i in library.get_vocab().items() if t[0] == space]] = True

    def one_by_one(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in library.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())), sizes

    def learn(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = np.fromiter((w[0] == " " and w[1:].isalpha() for w in words), bool, len(words))
        where = np.flatnonzero(plain)
        places, parts = [np.flatnonzero(~plain)], [one_by_one([w for w, p in zip(words, plain) if not p])]
        for k in range(0, len(where), TOGETHER):
            at = where[k : k + TOGETHER]
            own = [words[i] for i in at.tolist()]
            ids = np.array(library.encode_batch_fast(["".join(own)], add_special_tokens=False)[0].ids, np.int32)
            first = np.flatnonzero(begins[ids])
            places.append(at)
            parts.append((ids, np.diff(first, append=len(ids))) if len(first) == len(own) else one_by_one(own))
        flat, sizes = (np.concatenate(x) for x in zip(*parts))
        # back to the order of the words
        order = np.argsort(np.concatenate(places))
        return flat[spread((np.cumsum(sizes) - sizes)[order], sizes[order])], sizes[order]

    return Pool(learn, {t.content: i for i, t in library.get_added_tokens_decoder().items()}, LIBRARY_KEPT)


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """The vocabulary at a path, once per Python worker."""
    return Bpe(path)


def slices(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` code points, one text at least."""
    a = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= most:
            yield a, i + 1
            a, held = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def _encode(batches: Iterator[pa.RecordBatch], path: str, decoding: bool = False) -> Iterator[pa.RecordBatch]:
    """Replaces the last column, a text, by its ids; adds the text decoded from them if asked to."""
    bpe = load(path)
    for batch in batches:
        for k in range(0, batch.num_rows, SLICE_ROWS):
            b = batch.slice(k, SLICE_ROWS)
            texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
            for i, j in slices(texts):
                ids, counts = bpe.encode_batch(texts[i:j])
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(ids))
                columns, names = [*(c.slice(i, j - i) for c in b.columns[:-1]), lists], [*b.schema.names[:-1], "ids"]
                if decoding:
                    columns.append(bpe.decode_batch(lists))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)
        pa.default_memory_pool().release_unused()


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    bpe = load(path)
    for b in batches:
        for k in range(0, b.num_rows, SLICE_ROWS):
            part = b.slice(k, SLICE_ROWS)
            yield pa.RecordBatch.from_arrays([*part.columns, bpe.decode_batch(part.column(part.num_columns - 1))], [*b.schema.names, "decoded"])


def encode(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all but the text if None) and ids, an array of ints; a column named ids gives way."""
    held = [F.col(f"`{c}`") for c in keep] if keep is not None else without(docs, text_col, "ids")
    rows = docs.select(*held, F.col(f"`{text_col}`").alias("ids"))
    kind = T.StructType([*rows.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(partial(_encode, path=path), kind)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Adds decoded, the text of the ids; a column of that name gives way."""
    rows = encoded.select(*without(encoded, ids_col, "decoded"), F.col(f"`{ids_col}`"))
    return rows.mapInArrow(partial(_decode, path=path), T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))


def encode_decode(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """decode(encode(docs)) in one pass, with one vocabulary in each Python worker."""
    held = [F.col(f"`{c}`") for c in keep] if keep is not None else without(docs, text_col, "ids", "decoded")
    rows = docs.select(*held, F.col(f"`{text_col}`").alias("ids"))
    kind = T.StructType([*rows.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(partial(_encode, path=path, decoding=True), kind)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, and the digests of its ids and of the text decoded from them."""
    return encode_decode(docs, path, text_col, [id_col]).select(
        F.col(f"`{id_col}`"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
