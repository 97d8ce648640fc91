import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from siltbed.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, rest string"


def brute(rows):
    """Per row (size, source_size, target, taken), by the definition and in one place."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    by = defaultdict(list)
    for i, (_, _, s) in enumerate(rows):
        by[s].append(i)
    order = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total = {s: sum(size[i] for i in by[s]) for s in order}
    fixed, left = {}, set(order)
    while True:
        budget = 1.5 * sum(total.values()) - sum(fixed.values())
        dealt = {s: budget * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if dealt[s] > 2 * total[s]}
        if not over:
            break
        fixed |= {s: 2.0 * total[s] for s in over}
        left -= over
        if not left:
            break
    target = fixed | (dealt if left else {})
    out = {}
    for s in order:
        epochs = int(target[s] // max(total[s], 1))
        rest = round(target[s] - epochs * total[s])
        keyed = []
        for i in by[s]:
            d, t, _ = rows[i]
            h = hashlib.sha256("\x1f".join(["0", "" if d is None else str(d), t or ""]).encode()).hexdigest()
            w = 1 + 3 * (1 - min(1.0, abs(len(t or "") / max(size[i], 1) - 6) / 6))
            keyed.append((-math.log((int(h[:13], 16) + 0.5) / 2**52) / w, size[i], i))
        for _, n, i in sorted(keyed):
            part = max(0, min(n, rest))
            rest -= part
            out[i] = (n, total[s], target[s], epochs * n + part)
    return [out[i] for i in range(len(rows))]


def corpus(n):
    r = random.Random(9)
    text = lambda: " ".join("word" * r.randint(0, 3) + "x" for _ in range(r.choice([1, 5, 60])))
    rows = [(i, text(), r.choice(["hot"] * 6 + ["b", "é", "z", None, "𐀀", "￿"])) for i in range(n)]
    return [*rows, (n, None, "b"), (n + 1, "", "empty"), (n + 2, " \t\n", "empty"), (None, "a null id", "z"), (n + 3, "long " * 20_000, "long")]


@pytest.mark.parametrize("bits, last_rows", [(12, 1000), (2, 3)])
def test_matches_brute_force(spark, monkeypatch, bits, last_rows):
    monkeypatch.setattr(mixing, "LEVEL_BITS", bits)
    monkeypatch.setattr(mixing, "LAST_ROWS", last_rows)
    rows = corpus(400)
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    got = mixing.mix(df, keep=["doc_id"]).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for (i, _, _), (size, source_size, target, taken) in zip(rows, want):
        assert (by[i].size, by[i].source_size, by[i].taken) == (size, source_size, taken)
        assert by[i].target == pytest.approx(target)
    again = mixing.mix(df.repartition(3), keep=["doc_id"]).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_repeated_rows_share_what_is_left(spark):
    rows = [(1, "a b c d", "s")] * 5 + [(2, "e f g", "t")] * 2
    got = mixing.mix(spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA), keep=["doc_id"]).collect()
    want = brute(rows)
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r[0], w[3]) for r, w in zip(rows, want))


def test_the_mix_itself(spark):
    rows = corpus(60)
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    out = mixing.mixed(df)
    assert out.columns == df.columns
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    words = defaultdict(int)
    for r in out.collect():
        words[r.doc_id] += count(r.text)
        assert (dict((i, t) for i, t, _ in rows)[r.doc_id] or "").startswith(r.text)
    assert words == {r[0]: w[3] for r, w in zip(rows, brute(rows)) if w[3]}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_any_quality_meets_the_targets(spark):
    r = random.Random(2)
    odd = [None, float("nan"), 0.0, -3.0, 1e9, 1e-9, 1.0, float("inf")]
    rows = [(i, "word " * r.randint(1, 9), r.choice("ab"), r.choice(odd)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, q double").withColumns({"_src": F.lit(1), "_place": F.lit("x"), "taken": F.lit(2)})
    got = mixing.mix(df, quality_col="q", keep=["doc_id", "_src", "_place", "q"]).collect()
    assert len(got) == len(rows) and got[0].__fields__[:4] == ["doc_id", "_src", "_place", "q"]
    for source in {x.target for x in got}:
        own = [x for x in got if x.target == source]
        assert sum(x.taken for x in own) == round(source)
        epochs = int(source // own[0].source_size)
        best = [x for x in own if x.q == 1e9]
        worst = [x for x in own if x.q in (0.0, -3.0)]
        assert sum(x.taken - epochs * x.size for x in best) / sum(x.size for x in best) >= sum(x.taken - epochs * x.size for x in worst) / sum(x.size for x in worst)
