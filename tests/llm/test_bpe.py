import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

from siltbed.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "ab cd  \n\t'sé1२ñ漢!. \x1c\x1f\x85​　 😀﻿\x00İ"


def texts():
    r = random.Random(3)
    out = ["".join(r.choice(LETTERS) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    return [*out, "<|endoftext|>", "a<|endoftext|> b <|endoftext|>", "a" * 5000, " " * 50 + "x", "x" + " " * 50, "he'll  don't \n\n b", "", "the cat sat " * 9000]


def test_same_ids_as_the_library(spark):
    want = Tokenizer.from_file(PATH)
    rows = [*enumerate(texts()), (None, None), (7, "again"), (7, "again")]
    df = spark.createDataFrame([(i, t, "x", 1.0) for i, t in rows], "doc_id long, text string, ids string, decoded double")
    got = bpe.decode(bpe.encode(df, PATH), PATH)
    assert got.columns == ["doc_id", "ids", "decoded"]
    assert sorted(map(str, bpe.encode_decode(df, PATH).collect())) == sorted(map(str, got.collect()))
    seen = sorted((r.doc_id is None, r.doc_id or 0, r.ids, r.decoded) for r in got.collect())
    ids = [want.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    assert seen == sorted((i is None, i or 0, x, want.decode(x, skip_special_tokens=False)) for (i, _), x in zip(rows, ids))
    digest = {r.doc_id: r for r in bpe.round_trip(df.where("doc_id is not null"), PATH).collect()}
    for (i, t), x in zip(rows, ids):
        if i is not None and i > 10:
            assert digest[i].n_tokens == len(x)
            assert digest[i].ids_sha256 == hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()
            assert digest[i].decoded_sha256 == hashlib.sha256(want.decode(x, skip_special_tokens=False).encode()).hexdigest()


def test_letters_of_later_unicode_versions():
    own, lib = bpe.Bpe(PATH), Tokenizer.from_file(PATH)
    odd = ["a" + c + "1" + c + "!" + c for c in map(chr, [0x558, 0x1C89, 0xA7CB, 0xA7CE, 0x105C0, 0x10940, 0x18F48, 0x1E849, 0x2B32A, 0x378, 0x10FFFF])]
    odd += [" " + c + "b " + c + c + " word" for c in map(chr, [0x558, 0x1C89, 0xA7CB, 0x105C0, 0x1E849, 0x2B32A, 0x378, 0xAA, 0x2160, 0x300])]
    for pool in (own, bpe.library_pool(PATH)):
        ids, counts = pool.encode_batch(odd)
        assert ids.tolist() == [i for t in odd for i in lib.encode(t, add_special_tokens=False).ids] and len(counts) == len(odd)


def test_forgetting_changes_nothing():
    a, b = bpe.Bpe(PATH), bpe.Bpe(PATH)
    for t in texts()[:50]:
        x = a.encode_batch([t])[0].tolist()
        b.pool.forget()
        assert b.encode_batch([t])[0].tolist() == x


def test_long_texts_are_cut_where_words_end(monkeypatch):
    lib = Tokenizer.from_file(PATH)
    for pool in (bpe.Bpe(PATH), bpe.library_pool(PATH)):
        monkeypatch.setattr(bpe, "SLICE_CHARS", 7)
        monkeypatch.setattr(bpe, "KEPT", 20)
        for t in texts()[::40]:
            ids, counts = pool.encode_batch([t, "", t + " x"])
            one = lib.encode(t, add_special_tokens=False).ids
            assert ids.tolist() == [*one, *lib.encode(t + " x", add_special_tokens=False).ids] and counts.tolist()[:2] == [len(one), 0]


def test_bytes_that_are_no_text_decode_as_in_the_library(spark):
    own, lib = bpe.Bpe(PATH), Tokenizer.from_file(PATH)
    r = random.Random(5)
    rows = [[r.randrange(0, 300) for _ in range(r.randint(0, 6))] for _ in range(300)]
    for batch in (rows, [x for x in rows if all(i < 90 for i in x)]):
        assert own.decode_batch(bpe.pa.array(batch, bpe.pa.list_(bpe.pa.int32()))).to_pylist() == [lib.decode(x, skip_special_tokens=False) for x in batch]


def test_empty_table_and_odd_ids(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(df, PATH).count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [262, None, 99999])], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decode(odd, PATH).orderBy("doc_id").collect()] == ["", "", " the"]
