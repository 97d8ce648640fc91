import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from siltbed.llm import periodic

HEAD = "doc_id long, text string, runs string, Start int"


def brute(words):
    """All runs, from every stretch that agrees with itself q words on."""
    n, least = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                least.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in least.items())


def expected(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(key).encode())
    if key is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    collapsed = " ".join(w for i, w in enumerate(words) if i not in gone)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (key, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2], digest(lines), digest(collapsed))


def texts(r, n):
    out = []
    for _ in range(n):
        base, words = [r.choice("abc") for _ in range(r.randint(1, 12))], []
        for _ in range(r.randint(0, 6)):
            words += base * r.randint(1, 7) if r.random() < 0.7 else [r.choice("abx") for _ in range(r.randint(0, 9))]
            if r.random() < 0.4:
                base = base * r.randint(1, 4) + [r.choice("abc")]
        out.append(words[:300])
    return out


def test_all_runs_of_random_texts_match_brute_force():
    r = random.Random(7)
    for _ in range(40):
        group = texts(r, 20)
        assert [[tuple(x) for x in f.tolist()] for f in periodic._chunk(group)] == [brute(t) for t in group]


@pytest.mark.parametrize("words", [["a"] * 40, list("ab" * 30), list("aab" * 20 + "c"), list(("a" * 8 + "b") * 5), list(("a" * 16 + "b") * 4), list(("a" * 16 + "b") * 4)[1:], list("abcdefgh" * 3), list("aaaaa")])
def test_shapes(words):
    assert [tuple(x) for x in periodic._chunk([words])[0].tolist()] == brute(words)


def test_range_successor_matches_a_search():
    r = np.random.default_rng(3)
    values = r.permutation(300)
    tree = periodic.WaveletTree(values)
    left = r.integers(0, 300, 500)
    right = left + r.integers(0, 300 - left + 1)
    bound = r.integers(0, 310, 500)
    want = [min((v for v in values[a:b] if v >= x), default=300) for a, b, x in zip(left, right, bound)]
    assert tree.successor(left, right, bound).tolist() == want


def test_a_long_text_of_one_word_is_one_run():
    assert periodic._chunk([["x"] * 200_000])[0].tolist() == [[0, 200_000, 1]]


def test_report_matches_brute_force(spark):
    r = random.Random(5)
    rows = [(i, r.choice([" ", "\n", "\t ", "\x0b"]).join(t)) for i, t in enumerate(texts(r, 150))]
    rows += [(7, None), (7, ""), (8, " \n"), (None, "x " * 9), (3, "a b " * 5), (3, "a b " * 5), (200, "é é " * 8), (201, "A a " * 8)]
    df = spark.createDataFrame([(i, t, "mine", 1) for i, t in rows], HEAD)
    got = periodic.report(df, plant_by="doc_id").collect()
    order = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(map(tuple, got), key=order) == sorted((expected(i, t) for i, t in rows), key=order)
    # neither partitions nor neighbours matter
    assert sorted(map(tuple, periodic.report(df.repartition(5), plant_by="doc_id").collect()), key=order) == sorted(map(tuple, got), key=order)
    assert periodic.report(df.limit(0)).collect() == []


def test_detect_gives_runs_and_the_collapsed_text(spark):
    df = spark.createDataFrame([(1, "one " + "so it goes " * 5 + "end", "mine", 1)], HEAD)
    row = periodic.detect(df).first()
    assert [tuple(x) for x in row.runs] == [(1, 15, 3)] and row.collapsed == "one so it goes end" and row.n_words == 17
    assert row.Start == 1 and row.doc_id == 1
