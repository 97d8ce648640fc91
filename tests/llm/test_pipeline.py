import hashlib
import random
import re
import zlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from siltbed.llm import pii, toxicity
from tests.llm.test_mixing import brute as brute_mix


def corpus():
    r = random.Random(11)
    word = lambda: "".join(r.choice(["an", "the", "er", "ou", "st", "ble"]) for _ in range(r.randint(1, 5)))
    rows, labels = [], []
    for i in range(500):
        words = [word() for _ in range(r.randint(30, 120))]
        bad = r.random() < 0.2
        if bad:
            words[r.randrange(len(words))] = r.choice(["moron", "scum", "zubberan"])
        if r.random() < 0.2:
            words[5] = r.choice(["a.b@c.org", "10.20.30.40", "+1 (988) 555-2485"])
        rows.append((i, " ".join(words), "en", f"src{r.randrange(4)}", 0))
        labels.append((i, 1, int(bad)))
    for k in range(60):  # copies, exact and with one word changed
        words = rows[k][1].split()
        if k % 2 and len(words) > 60:
            words[-1] = "changed"
        rows.append((1000 + k, " ".join(words), "en", "src9", 0))
    rows += [(2000, "", "en", None, 0), (2001, None, "en", None, 0)]
    return rows, labels


def brute(rows, labels):
    """The stages one after the other, in one place, comparing all pairs."""
    truth = {i: t for i, _, t in labels}
    train = [(t or "", truth[i]) for i, t, *_ in rows if i in truth and zlib.crc32(str(i).encode()) % 3 != 1]
    model = toxicity.fit([t for t, _ in train], [y for _, y in train])
    scores, _ = toxicity.score_texts(model, [t for _, t, *_ in rows])
    kept = [r for r, s in zip(rows, scores) if s < 0.7]
    grams = []
    for _, t, *_ in kept:
        w = re.findall(r"\w+", (t or "").lower())
        grams.append([tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else [])
    root = list(range(len(kept)))
    for a in range(len(kept)):
        for b in range(a):
            x, y = set(grams[a]), set(grams[b])
            words = sum(len({k for i, g in enumerate(p) if g in q for k in range(i, i + 5)}) for p, q in ((grams[a], y), (grams[b], x)))
            if x and y and words >= 0.8 * (len(grams[a]) + len(grams[b]) + 8) and len(x & y) >= 0.6 * (len(x) * len(y)) ** 0.5 or not x and not y:
                root[a] = min(root[a], root[b])
    kept = [r for k, r in enumerate(kept) if root[k] == k]
    kept = [(i, pii.redact(t), s) for i, t, _, s, _ in kept]
    out = []
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for (i, t, _), (size, _, _, taken) in zip(kept, brute_mix(kept)):
        pieces = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", t or "")
        for text in [t] * (taken // max(size, 1)) + (["".join(pieces[: taken % size])] if size and taken % size else []):
            ids = lib.encode(text or "", add_special_tokens=False).ids
            out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out)


def test_matches_brute_force(spark, tmp_path):
    rows, labels = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    want = brute(rows, labels)
    assert got == want and 300 < len({r[0] for r in want}) < 560


def test_stages_keep_the_columns(spark, tmp_path):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows[:40], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
