import random

import numpy as np
import pytest
import xxhash

from siltbed.llm import simhash

SCHEMA = "doc_id long, text string, fp string, id int"


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


def corpus():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 6)))
    texts = [" ".join(word() for _ in range(r.choice([1, 3, 4, 5, 40, 400]))) for _ in range(60)]
    texts += [t[:-3] + " XyZ" for t in texts[:30]] + texts[5:25] + [None, "", " \t\n", "A b", "a B", "x" * 100_000, "w " * 30_000]
    return texts


def test_matches_brute_force(spark):
    texts = corpus()
    got = {r.doc_id: r for r in simhash.near_duplicates(spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], SCHEMA)).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{f:016x}" for f in fps]
    assert [got[i].component_id for i in range(len(texts))] == brute_components(fps, 4)


def test_buckets_cut_in_tiles_lose_no_link(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(4)]
    fps = sorted({b ^ sum(1 << r.randrange(64) for _ in range(r.randint(0, 3))) & (1 << 64) - 1 for b in base for _ in range(80)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, tile=8)
    got = {x.node: x.root for x in simhash.components(links).collect()}
    want = brute_components(fps, 4)
    groups = lambda keys: sorted(sorted(i for i, k in enumerate(keys) if k == v) for v in set(keys))
    assert groups([got.get(f, f) for f in signed]) == groups(want)


def test_spanning_links_of_all_block_counts():
    r = random.Random(2)
    for n in (10, 10**7, 10**9, 10**12):
        blocks = simhash.blocks_for(n, 4)
        masks = [m % (1 << 64) for m in simhash.block_masks(blocks, 4)]
        for _ in range(200):
            a = r.getrandbits(64)
            b = a ^ sum(1 << k for k in r.sample(range(64), 4))
            assert any(a & m == b & m for m in masks)
    f = np.array([[0], [1], [3], [1 << 40], [(1 << 41) | (1 << 40)], [2**64 - 1]], np.uint64)
    assert len(simhash.spanning_links(f, 4, step=2)) == 4


def test_dropping_keeps_one_row_each(spark):
    rows = [(1, "a b c d e f", "p", 1), (2, "a b c d e f", "q", 2), (2, "a b c d e f", "q", 2), (3, "other words here entirely now", "r", 3), (None, "third text with its own words", "s", None), (3, "zzz yyy xxx www vvv", "t", 4), (None, None, None, None)]
    out = simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "fp", "id"]
    kept = sorted((r.doc_id or 0, r.text or "") for r in out.collect())
    assert kept == sorted([(1, rows[0][1]), (3, rows[3][1]), (3, rows[5][1]), (0, rows[4][1]), (0, "")])


def test_dropping_finds_copies_of_similarity_080(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6)))
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    rows, copies, passage = [], set(), [word() for _ in range(60)]
    for i in range(0, 300, 2):
        a = [word() for _ in range(r.randint(80, 400))]
        b = list(a)
        for _ in range(len(a) // 50):
            b[r.randrange(len(b))] = word()
        if i % 4 == 0:  # a passage that many share makes no copies
            a, b = a + passage, [word() for _ in range(150)] + passage
        rows += [(i, " ".join(a), "p", 1), (i + 1, " ".join(b), "p", 1)]
        x, y = grams(a), grams(b)
        if len(x & y) >= 0.8 * len(x | y):
            copies.add(i + 1)
    kept = {x.doc_id for x in simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(copies) > 50 and not kept & copies
    assert {i for i in range(300) if i % 4 in (0, 1)} <= kept


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_only_copies_of_similarity_080_go(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(3, 7)))
    rows, gone = [], set()
    for n, share in enumerate([0.6, 0.7, 0.79, 0.81] * 30):
        # two texts with one passage in common, which is this share of either: cosine and share of words alike
        own = r.randint(400, 500)
        common = round(share * own)
        passage, ends = [word() for _ in range(common + 4)], [[word() for _ in range(own - common)] for _ in range(2)]
        a, b = passage + ends[0], passage + ends[1]
        x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
        assert abs(len(x & y) / (len(x) * len(y)) ** 0.5 - share) < 0.005
        rows += [(2 * n, " ".join(a), "p", 1), (2 * n + 1, " ".join(b), "p", 1)]
        if share > 0.8:
            gone.add(2 * n + 1)
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {x.doc_id for x in simhash.drop_near_duplicates(docs).collect()}
    clean = {i for i, *_ in rows} - gone
    assert clean <= kept
    assert not gone & kept


def test_checked_links_in_tiles(spark):
    r = np.random.default_rng(6)
    base = [np.unique(r.integers(0, 1 << 62, 60)) for _ in range(3)]
    sets = [np.sort(r.choice(b, r.integers(36, 54), replace=False)).tolist() for b in base for _ in range(30)]
    sets += [[], []]
    rows = [(0, 7, i, 0, s) for i, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "c int, k long, node long, w0 long, set array<long>")
    want = brute_groups(sets)
    for tile in (1 << 20, 300):
        got = {x.node: x.root for x in simhash.components(simhash.bucket_links(frame, ["w0"], 52, tile, 0.8)).collect()}
        assert [got.get(i, i) for i in range(len(sets))] == want
    assert 5 < len(set(want)) < 60


def brute_groups(sets):
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = set(sets[a]), set(sets[b])
            if bool(x) == bool(y) and 2 * len(x & y) >= 0.8 * (len(x) + len(y)) - 1e-9:
                p, q = root[a], root[b]
                root = [min(p, q) if z in (p, q) else z for z in root]
    return root


def test_repeated_lines_and_short_copies_are_found(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(3, 7)))
    rows = []
    for n in range(40):
        a = [word() for _ in range(100)]
        rows += [(2 * n, " ".join(a), "p", 1), (2 * n + 1, " ".join(a + a[88:] * 20), "p", 1)]  # 12 words again and again
    for n in range(40, 100):  # four shingles against five
        a = [word() for _ in range(9)]
        rows += [(2 * n, " ".join(a[:8]), "p", 1), (2 * n + 1, " ".join(a), "p", 1)]
    grams = lambda t: {tuple(w[i : i + 5]) for w in [t.split()] for i in range(len(w) - 4)}
    assert all(len(grams(a[1]) & grams(b[1])) >= 0.8 * len(grams(a[1]) | grams(b[1])) for a, b in zip(rows[::2], rows[1::2]))
    kept = {x.doc_id for x in simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert kept == {i for i, *_ in rows if i % 2 == 0}


def test_edits_of_every_kind_are_found(spark):
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(3, 7)))
    edits = {
        "words cut": lambda w: [x for k, x in enumerate(w) if k % 30],
        "sentences moved": lambda w: w[100:150] + w[:100] + w[150:],
        "header": lambda w: [word() for _ in range(25)] + w,
        "footer": lambda w: w + [word() for _ in range(25)],
        "case and commas": lambda w: [x.upper() + "," if k % 3 else x for k, x in enumerate(w)],
        "words put in": lambda w: [y for k, x in enumerate(w) for y in ([x, word()] if k % 40 == 0 else [x])],
    }
    rows, kinds = [], {}
    for n in range(120):
        a, kind = [word() for _ in range(r.randint(200, 400))], [*edits][n % len(edits)]
        rows += [(2 * n, " ".join(a), "p", 1), (2 * n + 1, " ".join(edits[kind](a)), "p", 1)]
        kinds[2 * n + 1] = kind
    kept = {x.doc_id for x in simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i for i, *_ in rows if i % 2 == 0} <= kept
    assert not [kinds[i] for i in kept & kinds.keys()]


def test_clashing_columns_and_hot_fingerprints(spark, monkeypatch):
    from siltbed.llm import common

    rows = [(i, "the same words in all of these", str(i), i, i, "x") for i in range(50)] + [(60, None, "a", 1, 2, "y"), (61, "others stand here on their own", "b", 1, 2, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string, _id long, _h long, `a.b` string")
    out = simhash.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [rows[0], rows[50], rows[51]]
    want = sorted(map(tuple, simhash.near_duplicates(df).collect()))
    for share in (1, 10**9):  # no key is hot, all are
        monkeypatch.setattr(common, "HOT_SHARE", share)
        assert sorted(map(tuple, simhash.near_duplicates(df).collect())) == want


def share(a, b):
    """Of both texts' words, those that stand in five in a row that the other has, too."""
    import re

    x, y = (re.findall(r"\w+", t.lower()) for t in (a, b))
    rows = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (x, y)]
    held = [{k for i in range(len(w) - 4) if tuple(w[i : i + 5]) in o for k in range(i, i + 5)} for w, o in ((x, rows[1]), (y, rows[0]))]
    return sum(map(len, held)) / max(1, len(x) + len(y)), rows


def test_scattered_edits_are_copies_and_half_of_a_text_is_not(spark):
    """Pairs at every Jaccard index that edits of single words give: the share of words in common shingles decides."""
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(3, 7)))
    rows, copies, clean = [], set(), set()
    for n in range(160):
        a = [word() for _ in range(r.randint(150, 400))]
        b = [word() if r.random() < (n % 8) * 0.015 else w for w in a]
        if n % 4 == 3:  # no copy: half of it is another text
            b = b[: len(b) // 2] + [word() for _ in range(len(b) // 2)]
        rows += [(2 * n, " ".join(a), "p", 1), (2 * n + 1, " ".join(b), "p", 1)]
        own, (x, y) = share(rows[-2][1], rows[-1][1])
        cosine = len(x & y) / (len(x) * len(y)) ** 0.5
        if own >= 0.8 and cosine >= 0.6:
            copies.add((2 * n + 1, round(len(x & y) / len(x | y), 1)))
        else:
            clean.add(2 * n + 1)
    kept = {x.doc_id for x in simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {j for _, j in copies} >= {0.5, 0.6, 0.7, 0.8, 0.9} and len(clean) >= 40
    assert clean <= kept and {i for i, *_ in rows if i % 2 == 0} <= kept
    assert len(kept & {i for i, _ in copies}) <= 1  # a key is shared with a chance of over 0.99
    strict = {x.doc_id for x in simhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA), least=0.97).collect()}
    assert kept < strict


def test_copies_and_clean_documents_of_the_given_tables(spark):
    """Every edited copy goes, and no text goes that has not four fifths of its words in common shingles with another."""
    import os
    from collections import defaultdict

    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("no tables here")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {x.doc_id: x.text or "" for x in docs.collect()}
    kept = {x.doc_id for x in simhash.drop_near_duplicates(docs).select("doc_id").collect()}
    by = defaultdict(list)
    for i, t in texts.items():
        for h in set(simhash.shingle_hashes(t, 5, True).tolist()):
            by[h].append(i)
    near = defaultdict(int)
    for ids in by.values():
        for a in ids if len(ids) < 50 else []:
            for b in ids:
                near[a, b] += a < b
    links = {(a, b) for (a, b), n in near.items() if n and share(texts[a], texts[b])[0] >= 0.8}
    linked = {x for ab in links for x in ab}
    later = {b for _, b in links}
    assert len(later) > 30 and len(later & kept) <= len(later) // 10
    gone = texts.keys() - kept
    assert all(i in linked or not texts[i].strip() or len(by[next(iter(simhash.shingle_hashes(texts[i], 5, True).tolist()))]) >= 2 for i in gone)


def test_common_shingles_are_counted_all_at_once(monkeypatch):
    r = np.random.default_rng(8)
    sets = [np.sort(r.choice(300, r.integers(0, 60), replace=False)) for _ in range(70)]
    got = simhash.common_counts(sets[:40], sets[40:])
    assert (got == [[len(np.intersect1d(x, y)) for y in sets[40:]] for x in sets[:40]]).all()
    texts = [r.permutation(r.choice(sets[k % 5], 40)) for k in range(200) if len(sets[k % 5]) > 10] + [np.empty(0, np.int64)] * 3
    words = np.zeros((len(texts), 1), np.uint64)
    one, all_ = (None, None)
    for together in (10**9, 0):
        monkeypatch.setattr(simhash, "TOGETHER", together)
        monkeypatch.setattr(simhash, "COLUMNS", 7)
        root = list(range(len(texts)))
        for u, v in simhash.spanning_links(words, 4, 32, texts, 0.8, 1).tolist():
            p, q = root[u], root[v]
            root = [min(p, q) if x in (p, q) else x for x in root]
        one, all_ = root, one
    assert one == all_ and 3 < len(set(one)) < len(texts)


def written(spark):
    """Bytes that all shuffles of this session have written."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()


def test_texts_that_stay_are_not_exchanged(spark):
    r = random.Random(31)
    texts = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz     ", k=30_000)) for _ in range(200)]
    texts += [t + " end" for t in texts[:5]] + texts[5:10]
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], SCHEMA).repartition(4).localCheckpoint()
    before = written(spark)
    kept = simhash.drop_near_duplicates(docs).select("doc_id").collect()
    assert sorted(x.doc_id for x in kept) == list(range(200))
    assert written(spark) - before < sum(map(len, texts)) / 4


def test_repeated_rows_with_and_without_a_filter(spark, monkeypatch):
    r = random.Random(32)
    text = lambda: " ".join("".join(r.choices("abcdefgh", k=5)) for _ in range(60))
    own = [text() for _ in range(30)]
    rows = [(i, t, "p", i) for i, t in enumerate(own)] + [(i, t, "p", i) for i, t in enumerate(own[:10])]
    rows += [(100 + i, t + " more", "q", i) for i, t in enumerate(own[5:15])] + [(3, own[20], "r", 0), (None, own[21], "r", 0), (None, text(), "n", 0)] * 2 + [(None, None, None, None), (200, "", "e", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sorted([(i, t) for i, t in enumerate(own) if i != 20] + [(3, own[20]), (-1, rows[-3][1]), (200, "")])
    for filtered in (simhash.key_filter, lambda *a: None):
        monkeypatch.setattr(simhash, "key_filter", filtered)
        got = sorted((-1 if x.doc_id is None else x.doc_id, x.text) for x in simhash.drop_near_duplicates(docs).collect())
        assert got == want


def test_keys_of_one_text_are_not_compared(spark):
    named = spark.createDataFrame([("a", 1, [7, 8, 9]), ("b", 2, [7, 1, 9]), ("c", 3, [8, 8, 2])], "h string, w0 long, keys array<long>")
    got = sorted(tuple(x) for x in simhash._shared(named, ["w0"]).collect())
    assert got == [(0, 7, "a", 1), (0, 7, "b", 2), (1, 8, "a", 1), (1, 8, "c", 3), (2, 9, "a", 1), (2, 9, "b", 2)]
