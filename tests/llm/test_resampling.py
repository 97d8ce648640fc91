import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from siltbed.llm import resampling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    words = WORD.findall((text or "").translate(LOW))
    return [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)], len(words)


def brute(docs, target, percent, least, buckets, longest):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own = [(i, *features(t, longest)) for i, t in docs]
    s, t = [0] * buckets, [0] * buckets
    for _, fs, _ in own:
        for f in fs:
            s[bucket(f)] += 1
    for text in target:
        for f in features(text, longest)[0]:
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, fs, n in own:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[bucket(f)] for f in fs)
        rows.append([i, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], -r[1]))
    for k, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


def order(x):
    return tuple((v is not None, v) for v in x)


@pytest.mark.parametrize("longest,buckets,percent", [(1, 10_000, 10), (2, 50, 35), (1, 7, 100), (1, 10_000, 0)])
def test_report_matches_brute_force(spark, longest, buckets, percent):
    r = random.Random(longest * 100 + percent)
    words = ["Alpha", "béta", "g4mma", "ÉTÉ", "d", "x_y", "İ", "中文", "e'f"]
    text = lambda: r.choice([" ", "\x00", ", "]).join(r.choice(words) for _ in range(r.randint(0, 60)))
    docs = [(i, text()) for i in range(400)] + [(None, text()), (None, "a " * 30), (5, "a " * 30), (5, "a " * 30), (6, None), (7, ""), (8, "!?")]
    target = ["alpha béta " * 5, None, "", "new words only here"]
    df = spark.createDataFrame([(i, t, 1, "mine") for i, t in docs], "doc_id long, text string, rank int, _at string").repartition(5)
    got = resampling.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), percent=percent, buckets=buckets, longest=longest)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=order) == sorted(brute(docs, target, percent, 20, buckets, longest), key=order)


def test_columns_that_are_kept_and_empty_tables(spark):
    df = spark.createDataFrame([(i, "a b c " * 10, "s", i) for i in range(10)], "doc_id long, text string, source string, score long")
    target = df.limit(1)
    got = resampling.resample(df, target, percent=20, keep=["doc_id", "source", "score"])
    assert got.columns == ["doc_id", "source", "n_features", "weight", "score", "rank"] and got.where("rank is not null").count() == 2
    assert resampling.resample(df.limit(0), target).collect() == []
    assert resampling.resample(df, target.limit(0)).count() == 10


@pytest.mark.parametrize("spread", [3, 10**6])
def test_the_cutoff_is_exact_by_medians_alone(spark, spread):
    r = random.Random(spread)
    keys = [(r.randrange(spread), -i % 50) for i in range(3000)]
    df = spark.createDataFrame(keys, "score long, id long").repartition(6)
    want = sorted(keys, reverse=True)
    for n in (1, 2, 700, 1500, 2999, 3000):
        assert resampling.cutoff(df, n, most=0 if n == 700 else 40) == want[n - 1]
    assert resampling.cutoff(df, 3001) is None and resampling.cutoff(df, 0) is None and resampling.cutoff(df.limit(0), 1) is None


def test_a_weighted_median_leaves_half_of_the_weight_on_either_side():
    r = np.random.default_rng(1)
    for _ in range(200):
        n = int(r.integers(1, 20))
        keys, weights = r.integers(0, 9, (n, 2)), r.integers(1, 9, n)
        m = tuple(resampling.weighted_median(keys, weights).tolist())
        below = sum(w for k, w in zip(map(tuple, keys.tolist()), weights) if k <= m)
        above = sum(w for k, w in zip(map(tuple, keys.tolist()), weights) if k >= m)
        assert 2 * below >= weights.sum() and 2 * above >= weights.sum()


def test_results_do_not_depend_on_partitions(spark):
    r = random.Random(9)
    rows = [(i, " ".join(r.choice("abcdefgh") for _ in range(30))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one, many = (sorted(map(tuple, resampling.resample(df.repartition(n), df.limit(3)).collect()), key=order) for n in (1, 11))
    assert one == many and sum(x[4] is not None for x in one) == 30
