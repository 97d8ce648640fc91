import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from siltbed.llm import iblt

SCHEMA = "doc_id long, text string, range string, id int"


def brute_likeness(a, b):
    x, y = Counter(iblt.pieces(a)), Counter(iblt.pieces(b))
    both, every = sum((x & y).values()), sum((x | y).values())
    return both / every if every else 1.0


def brute_edit(text, following):
    n = len(text) // 2
    return text[: len(text) - n] + following[:n]


def test_sketches_recover_differences():
    r = np.random.default_rng(7)
    a, b, wants = [], [], []
    for shared, mine, theirs in [(0, 0, 0), (50, 0, 0), (100, 3, 5), (10, 40, 1), (500, 300, 400), (0, 2000, 0), (0, 0, 7)] * 3:
        keys = r.integers(0, 1 << 64, shared + mine + theirs, np.uint64)
        a.append(keys[: shared + mine])
        b.append(np.r_[keys[:shared], keys[shared + mine :]])
        wants.append((set(keys[shared : shared + mine]), set(keys[shared + mine :])))
    keys, pair, sign = iblt.differences(a, b)
    for k, (x, y) in enumerate(wants):
        assert set(keys[(pair == k) & (sign > 0)]) == x and set(keys[(pair == k) & (sign < 0)]) == y
    assert len(iblt.differences([], [])[0]) == 0


def test_repeated_pieces_count():
    x, y = iblt.digests("a b\n" * 5000), iblt.digests("a b\n" * 4000)
    assert iblt.likenesses([x, y, x], [y, x, x]).tolist() == pytest.approx([0.8, 0.8, 1.0])
    assert iblt.fingerprint("a b\nc") == iblt.fingerprint("a b\nc") != iblt.fingerprint("a b\nd")


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_matches_brute_force(spark, parts):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdé😀") for _ in range(r.randint(1, 5)))
    rows = [(i * 7 % 1000, "\n".join(" ".join(word() for _ in range(r.randint(1, 40))) for _ in range(r.randint(0, 12)))) for i in range(120)]
    rows += [(2000, None), (2001, ""), (2002, rows[5][1]), (2003, rows[5][1]), (-4, "long " * 30_000), (None, "no id")]
    got = {x.doc_id: x for x in iblt.compared(spark.createDataFrame([(*x, "x", 1) for x in rows], SCHEMA), parts=parts).collect()}
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0)))
    assert len(got) == len(rows)
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        t, n = t or "", n or ""
        e = brute_edit(t, n)
        x = got[i]
        assert (x.n_chars, x.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert (x.fingerprint, x.edited_fingerprint) == (iblt.fingerprint(t), iblt.fingerprint(e))
        assert x.near_edited == pytest.approx(brute_likeness(t, e)) and x.near_next == pytest.approx(brute_likeness(t, n))
    assert got[2003].near_next == 1.0


def test_small_tables(spark):
    df = spark.createDataFrame([(5, "one two three four", "x", 1)], SCHEMA)
    one = iblt.compared(df).first()
    assert one.near_next == 1.0 and one.n_chars == 18
    same = iblt.compared(df.union(df).union(df)).collect()
    assert len(same) == 3 and len(set(same)) == 1
    assert iblt.compared(df.limit(0)).count() == 0


def test_ids_must_be_integers(spark):
    import pytest

    with pytest.raises(TypeError):
        iblt.compared(spark.createDataFrame([("a", "x")], "doc_id string, text string"))
    clash = spark.createDataFrame([(1, "x. y", 1, "h", 2), (1, "x. y", 1, "h", 2)], "doc_id int, text string, range int, h string, guest int")
    assert [r.near_next for r in iblt.compared(clash).collect()] == [1.0, 1.0]


@pytest.mark.parametrize("parts", [2, 8])
def test_ids_that_many_rows_share_are_cut_by_their_texts(spark, parts):
    r = random.Random(6)
    text = lambda: ". ".join(str(r.randrange(99)) for _ in range(r.randint(0, 9)))
    rows = [(None, text()) for _ in range(150)] + [(7, text()) for _ in range(150)] + [(-5, text()) for _ in range(100)] + [(r.randrange(20), text()) for _ in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    order = sorted(df.selectExpr("doc_id", "text", "xxhash64(text) AS h").collect(), key=lambda x: (x.doc_id is None, -(x.doc_id or 0), x.h))
    want = Counter((x.doc_id, len(x.text), hashlib.sha256(brute_edit(x.text, n.text).encode()).hexdigest()) for x, n in zip(order, order[1:] + order[:1]))
    assert Counter((x.doc_id, x.n_chars, x.edited_sha256) for x in iblt.compared(df, parts=parts).collect()) == want
    cut = iblt.Ranges(df.selectExpr("doc_id AS id", "text"), 8)
    assert cut.nulls >= 2 and 7 in cut.heavy
    sizes = df.selectExpr("doc_id AS id", "text").withColumn("_interval", cut.interval()).groupBy(cut.range_of(iblt.F.xxhash64("text")).alias("range")).count().collect()
    assert max(x["count"] for x in sizes) < 150 and max(x.range for x in sizes) < cut.total
