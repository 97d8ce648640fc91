import itertools
import random
import zlib

import numpy as np

from siltbed.llm import toxicity


def test_marginals_match_enumeration():
    r = np.random.default_rng(3)
    lengths = [1, 4, 2, 6]
    emit, trans = r.normal(size=sum(lengths)), r.normal(size=(2, 2))
    starts = np.cumsum([0, *lengths])[:-1]
    p, moves = toxicity.marginals(emit, starts, trans)
    want, want_moves = [], np.zeros((2, 2))
    for s, n in zip(starts, lengths):
        ways = list(itertools.product((0, 1), repeat=n))
        weight = np.array([np.exp(sum(emit[s + i] * y for i, y in enumerate(w)) + sum(trans[a, b] for a, b in zip(w, w[1:]))) for w in ways])
        weight /= weight.sum()
        want += [sum(weight[k] for k, w in enumerate(ways) if w[i]) for i in range(n)]
        for k, w in enumerate(ways):
            for a, b in zip(w, w[1:]):
                want_moves[a, b] += weight[k]
    assert np.allclose(p, want) and np.allclose(moves, want_moves)


def corpus(n=900):
    r = random.Random(2)
    word = lambda: "".join(r.choice(["an", "the", "er", "ou", "st", "ble"]) for _ in range(r.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(r.randint(5, 120))]
        bad = r.random() < 0.2
        if bad:
            for _ in range(r.randint(1, 3)):
                words.insert(r.randrange(len(words)), r.choice(["Moron", "zubberish", "zubberan", "zubberest"]))
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 0, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_spans(spark):
    rows, labels = corpus()
    extra = [(2000, None, "s"), (2001, "", "s"), (None, "what a moron", "s"), (2002, "fine words " * 5000 + "moron", "s"), (2002, "fine words " * 5000 + "moron", "s")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, score string")
    known = spark.createDataFrame([*labels, (None, 0, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.predictions(docs, known).collect()
    assert len(got) == len(rows) + len(extra)
    by = {r.doc_id: r for r in got}
    truth = {i: t for i, _, t in labels}
    test = [r for r in got if r.held_out and r.doc_id in truth]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.held_out for r in got if r.doc_id is not None)
    assert all(r.predicted == truth[r.doc_id] for r in test) and len(test) > 200
    assert by[2000].predicted == by[2001].predicted == 0 and by[2002].predicted == 1 and by[None].toxic_spans == "7:12"
    assert by[2002].toxic_spans == f"{len('fine words ' * 5000)}:{len('fine words ' * 5000) + 5}"
    kept = toxicity.drop_toxic(docs, known)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_without_labels_of_both_classes(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.predictions(docs, none).collect()] == [0.0, 0.0]
    assert toxicity.predictions(docs.limit(0), none).count() == 0


def test_later_rows_of_the_sample_are_fitted_to():
    r = random.Random(7)
    word = lambda: "".join(r.choice(["an", "the", "er", "ou", "st", "ble"]) for _ in range(r.randint(2, 5)))
    texts, labels = [], []
    for i in range(2000):
        words = [word() for _ in range(12)]
        if i % 2:
            words[3] = "zub" if i < 1800 else "qix"
        texts.append(" ".join(words))
        labels.append(i % 2)
    model = toxicity.fit(texts, labels)
    assert model.weights["=zub"] > 0 and model.weights["=qix"] > 0.5
    scores, _ = toxicity.score_texts(model, ["there qix stou", "there stou"])
    assert scores[0] > toxicity.THRESHOLD > scores[1]


def test_ids_that_repeat_and_clashing_columns(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t, *_ in rows], "doc_id long, text string, _text string, `a.b` string, Score int")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    again = docs.union(docs.selectExpr("doc_id", "'zzz other words'", "_text", "`a.b`", "Score"))
    model = toxicity.train(again.repartition(5), known)
    assert model.mark == toxicity.train(again.repartition(2), known).mark
    few = toxicity.train(docs, known, most_toxic=20, most_clean=30, most_features=3)
    assert len(few.weights) <= 3
    got = toxicity.score(docs, model)
    assert got.columns == ["doc_id", "text", "_text", "a.b", "score", "toxic_spans"] and got.count() == docs.count()
    assert toxicity.drop_toxic(docs, known).columns == docs.columns


def test_scores_match_a_plain_version():
    rows, labels = corpus()
    truth = {i: t for i, _, t in labels}
    known = [(t, truth[i]) for i, t, *_ in rows if i in truth]
    model = toxicity.fit([t for t, _ in known], [y for _, y in known])
    texts = [*(t for _, t, *_ in rows[:60]), "", "moron", "one moron two"]
    scores, _ = toxicity.score_texts(model, texts)
    for text, got in zip(texts, scores):
        odds = [model.odds(w) for w in toxicity.WORD.findall(text)]
        x = [0.0, 0.0]
        if odds:
            # forward and backward messages, one token after the other
            pot, emit, n = np.exp(model.trans), np.exp(np.array([[0.0, e] for e in odds])), len(odds)
            alpha, beta = [emit[0] / emit[0].sum()], [np.ones(2)]
            for k in range(1, n):
                a = (alpha[-1] @ pot) * emit[k]
                alpha.append(a / a.sum())
            for k in range(n - 1, 0, -1):
                b = pot @ (emit[k] * beta[-1])
                beta.append(b / b.sum())
            p = np.array([(a * b / (a * b).sum())[1] for a, b in zip(alpha, beta[::-1])])
            x = [p.max(), np.log1p(p.sum())]
        z = model.curve[0] + (model.curve[1:] @ x)
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-6
