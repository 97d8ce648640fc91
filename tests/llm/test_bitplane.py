import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from siltbed.llm import bitplane

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("bits", [False, True])
def test_file_round_trip(bits, monkeypatch):
    monkeypatch.setattr(bitplane, "BLOCK_IDS", 100)
    r = np.random.default_rng(1)
    counts = [1, 7, 0, 350, 100, 3]
    ids = r.integers(0, 1 << 32, sum(counts), np.uint32)
    f = bitplane.PlaneFile(bitplane.write_file(ids, ["a", None, 3, 4, 5, 6], counts, bits))
    assert [d for d, _, _ in f.documents()] == ["a", None, 3, 4, 5, 6]
    assert np.array_equal(np.concatenate([x for _, _, x in f.documents()]), ids)
    assert np.array_equal(f.ids(95, 205), ids[95:205]) and len(f.ids(5, 5)) == 0
    with pytest.raises(ValueError):
        bitplane.PlaneFile(b"x" * 50)


def test_matches_the_library(spark, monkeypatch):
    r = random.Random(6)
    rows = [(i, " ".join(r.choice(["the", "été", "x1", "  ", "\n"]) for _ in range(r.randint(0, 60))), "s", i) for i in range(500)]
    rows += [(501, None, None, 0), (502, "", None, 0), (503, "long text " * 20_000, "s", 0), (7, rows[7][1], "s", 0)]
    r.shuffle(rows)
    got = bitplane.digests(spark.createDataFrame(rows, "doc_id long, text string, part string, start long"), PATH).collect()
    lib = Tokenizer.from_file(PATH)
    at, want = 0, []
    for i, t, *_ in sorted(rows, key=lambda x: x[0]):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(x) for x in got) == want


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "c")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.start) for r in bitplane.digests(df, PATH).collect()) == [(0, 0), (1, 3)]
    assert bitplane.digests(df.limit(0), PATH).count() == 0


def test_kinds_of_ids(spark):
    for kind in ("short", "int", "string"):
        got = bitplane.digests(spark.createDataFrame([(1, "a b", 0), (2, None, 0)], "doc_id long, text string, data int").selectExpr(f"cast(doc_id as {kind}) doc_id", "text", "data"), PATH)
        assert got.schema["doc_id"].dataType.simpleString().replace("smallint", "short") == kind and got.count() == 2
    with pytest.raises(TypeError):
        bitplane.digests(spark.createDataFrame([(1.5, "a")], "doc_id double, text string"), PATH)
