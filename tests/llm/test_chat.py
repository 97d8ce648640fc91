import hashlib
import random

import pytest

from siltbed.llm import chat

ODD = ["", "\\", "<s>", "</s>", "<\\s>", "[INST]", "[/INST]", "[\\INST]", "[SYS]x[/SYS]", "[ROLE]", "\\\\<s>\\", "<", "</", "s>", "a\nb", "é😀", "[[INST]]", "<<s>>"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_turns_come_back_whatever_they_say():
    r = random.Random(2)
    for _ in range(2000):
        turns = [(r.choice(["system", "user", "assistant", "tool", "", "[ROLE]\\"]), "".join(r.choice(ODD) for _ in range(r.randint(0, 5)))) for _ in range(r.randint(0, 4))]
        made = [chat.turn(*t) for t in turns]
        text = "".join(t for t, _, _ in made)
        assert list(chat.parsed(text)) == turns
        for (own, a, b), (_, said) in zip(made, turns):
            assert chat.unescaped(own[a:b]) == said
            assert not any(c in own[a:b] for c in ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]"))
    with pytest.raises(ValueError):
        list(chat.parsed("<s>a</s>b"))


def fold(events):
    """The messages of one conversation's events, in one place."""
    texts, roles, gone = {}, {}, set()
    for m, _, kind, role, text, start, length in sorted(events, key=lambda e: e[:2]):
        old = texts.setdefault(m, "")
        if kind == "open":
            roles[m], texts[m] = role, text or ""
            gone.discard(m)
        elif kind == "delta":
            texts[m] = old + (text or "")
        elif kind == "regenerate":
            texts[m] = ""
        elif kind == "remove":
            gone.add(m)
        else:
            a, b = (0, len(old)) if start is None else (start, len(old) if length is None else start + length)
            texts[m] = old[:a] + (text or "") + old[b:]
    return [(roles.get(m) or "", texts[m]) for m in sorted(texts) if m not in gone]


LOG = "conv_id string, block long, message long, seq long, kind string, role string, text string, start long, length long"


def test_logs_fold_as_they_do_in_one_place(spark):
    r = random.Random(3)
    logs = {c: [] for c in ["a", "b", None, "long"]}
    for c, events in logs.items():
        for m in range(40 if c == "long" else 5):
            for seq in range(r.randint(1, 9)):
                kind = "open" if seq == 0 and r.random() < 0.9 else r.choice(["delta", "delta", "edit", "regenerate", "remove" if r.random() < 0.1 else "delta"])
                at = r.choice([None, 0, 1, 5])
                events.append((m, seq, kind, r.choice(["user", "assistant", None]) if kind == "open" else None, r.choice([None, *ODD, "words of it"]), at if kind == "edit" else None, r.choice([None, 0, 2]) if kind == "edit" else None))
    rows = [(c, m // 8 if c == "long" else None, *e) for c, events in logs.items() for m, *rest in events for e in [(m, *rest)]]
    r.shuffle(rows)
    out = chat.formatted(spark.createDataFrame(rows, LOG)).collect()
    for c, events in logs.items():
        parts = sorted((x for x in out if x.conv_id == c), key=lambda x: (x.block or 0, x.part))
        want = fold(events)
        assert list(chat.parsed("".join(p.formatted for p in parts))) == want
        assert [chat.unescaped(p.formatted[s.start : s.end]) for p in parts for s in p.loss] == [t for role, t in want if role == "assistant"]
        assert sum(p.n_turns for p in parts) == len(want)
        assert len(parts) == (5 if c == "long" else 1) and all(p.is_whole == (c != "long") for p in parts)


def expected(rows):
    by = {}
    for c, n, role, text in [*rows, (-7, 0, "user", chat.PLANTED), (-7, 1, "assistant", chat.PLANTED)]:
        by.setdefault(c, []).append((n is not None, n, role is not None, role or "", text or ""))
    out = set()
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t for *_, role, t in turns if role == "assistant")
        out.add((c, len(turns), sha("".join(f"{role}\n{t}\n" for *_, role, t in turns)), len(loss), sha(loss), sum(len(chat.turn(role, t)[0]) for *_, role, t in turns)))
    return out


@pytest.mark.parametrize("long,chars", [(4096, 1 << 20), (8, 1 << 20), (4096, 300)])
def test_report_matches_brute_force(spark, monkeypatch, long, chars):
    """Also with conversations that are dealt out, and with parts so small that most have several."""
    monkeypatch.setattr(chat, "LONG", long)
    r = random.Random(4)
    rows = [(c, t, r.choice(["system", "user", "assistant", "tool", None]), r.choice([None, *ODD, "some text of a turn " * r.randint(1, 9)])) for c in range(6) for t in range(-3, 12)]
    rows += [(1, 3, "user", "again"), (1, 3, "user", "again"), (1, None, "user", "no turn"), (None, 0, "user", "no conversation"), (50, 0, "assistant", "x</s>" * 20_000)]
    rows += [(99, t, "user", f"turn {t}") for t in range(40)]
    df = spark.createDataFrame([(*x, 1) for x in rows], "conv_id long, turn long, role string, text string, block int").repartition(3)
    if chars == 300:
        # workers see the constant of the module they import: parts are cut by hand instead
        out = chat.formatted(chat.log_of(df.select("conv_id", "turn", "role", "text")))
        cut = []
        for x in out.collect():
            turns = [chat.turn(*t)[0] for t in chat.parsed(x.formatted)]
            at = 0
            for i, own in enumerate(turns):
                cut.append((x.conv_id, x.block, i, len(turns) == 1, 1, own, [(s.start - at, s.end - at) for s in x.loss if at <= s.start < at + len(own)]))
                at += len(own)
        got = chat.read_back(spark.createDataFrame(cut, out.schema).repartition(4)).collect()
        assert {tuple(x) for x in got} == {x for x in expected(rows) if x[0] != -7}
    else:
        got = chat.report(df).collect()
        assert len(got) == len({x[0] for x in rows}) + 1
        assert {tuple(x) for x in got} == expected(rows)


def test_the_log_is_longer_than_the_rows_and_empty_tables_pass(spark):
    df = spark.createDataFrame([(1, 0, "user", "a question of some length"), (1, 1, "assistant", "an answer")], "conv_id long, turn long, role string, text string")
    log = chat.log_of(df)
    kinds = {x.kind for x in log.collect()}
    assert kinds == {"open", "delta", "edit", "regenerate", "remove"}
    assert chat.formatted(chat.log_of(df.limit(0))).collect() == []
    assert [x.conv_id for x in chat.report(df.limit(0)).collect()] == [-7]


def test_one_exchange_moves_the_texts(spark):
    df = spark.createDataFrame([(1, 0, "user", "q")], "conv_id long, turn long, role string, text string")
    plan = chat.formatted(chat.log_of(df))._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert sum("Exchange hashpartitioning" in line and "REPARTITION" in line for line in plan.splitlines()) == 1
    assert plan.count("ENSURE_REQUIREMENTS") <= 1  # the count of rows by conversation
