"""Windows over keys of any size: equal to plain windows, and no task with all of a hot key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from siltbed.operators import dimensional, history, ordered

ORDER = ["t", "id"]


@pytest.fixture(scope="module")
def events(spark):
    r = random.Random(1)
    rows = [(r.choice(["hot"] * 6 + ["a", "b", None]), r.randrange(300) if i % 9 else None, i, r.choice(["x", "y", None])) for i in range(3000)]
    return spark.createDataFrame(rows, "k string, t int, id int, v string").repartition(5).cache()


def shown(df):
    return sorted(map(str, df.collect()))


def many(df):
    """Slices of the hot key."""
    return ordered.Sliced(df, ["k"], ORDER, least=200).rows.where("k = 'hot'").groupBy("_slice").count()


def test_a_hot_key_is_cut_into_even_slices(events):
    found = many(events).collect()
    n = sum(r["count"] for r in found)
    assert len(found) >= 5 and max(r["count"] for r in found) < n / 2
    assert not ordered.Sliced(events, ["k"], ORDER).hot
    assert not ordered.Sliced(events.limit(0), ["k"], ORDER, least=0).hot


@pytest.mark.parametrize("least", [100, 10**6])
def test_all_equal_plain_windows(events, least):
    w = Window.partitionBy("k").orderBy(*ORDER)
    frame = w.rowsBetween(Window.unboundedPreceding, 0)
    assert shown(ordered.before(events, ["k"], ORDER, {"p": "v", "q": "id"}, least=least)) == shown(events.withColumns({"p": F.lag("v").over(w), "q": F.lag("id").over(w)}))
    assert shown(ordered.after(events, ["k"], ORDER, {"p": "v"}, least=least)) == shown(events.withColumn("p", F.lead("v").over(w)))
    assert shown(ordered.numbered(events, ["k"], ORDER, "n", least=least)) == shown(events.withColumn("n", F.row_number().over(w).cast("long")))
    assert shown(ordered.filled(events, ["k"], ORDER, "v", "f", least=least)) == shown(events.withColumn("f", F.last("v", True).over(frame)))
    past = F.coalesce(F.sum("id").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    assert shown(ordered.summed(events, ["k"], ORDER, "id", "s", least=least)) == shown(events.withColumn("s", past))
    got = ordered.pieces(events, ["k"], ORDER, ["id", "v"], 70, least=least).collect()
    assert max(len(r.rows) for r in got) == 70
    by = {}
    for r in sorted(got, key=lambda r: r.piece):
        by.setdefault(r.k, []).extend(x.id for x in r.rows)
    assert by == {k: [x.id for x in events.where(F.col("k").eqNullSafe(k)).orderBy(*ORDER).collect()] for k in ("hot", "a", "b", None)}


def test_cuts_of_the_whole_hold_for_a_part(events):
    known = ordered.cuts(events, ["k"], ["t"], 200)
    part = events.where("id % 3 = 0")
    w = Window.partitionBy("k").orderBy(*ORDER)
    assert shown(ordered.before(part, ["k"], ORDER, {"p": "id"}, known)) == shown(part.withColumn("p", F.lag("id").over(w)))


def test_no_window_has_all_of_the_hot_key(events):
    out = ordered.before(events, ["k"], ORDER, {"p": "v"}, least=200)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "_end" not in line and "_at" not in line]
    assert windows and all("_slice" in line for line in windows)


@pytest.mark.parametrize("least", [150, 10**6])
def test_history_of_a_hot_key(events, least):
    rows = events.where("t is not null and v is not null and k is not null")
    one = history.collapse(rows, ["k"], ORDER, "v")
    got = history.collapse(rows, ["k"], ORDER, "v", known=ordered.cuts(rows, ["k"], ["t"], least))
    assert shown(got) == shown(one)
    cuts = ordered.cuts(rows, ["k"], ["t"], least)
    assert shown(history.intervals(one, ["k"], ORDER, "t", "until", "now", known=cuts)) == shown(history.intervals(one, ["k"], ORDER, "t", "until", "now"))


@pytest.mark.parametrize("least", [100, 10**6])
def test_as_of_join_of_a_hot_key(spark, events, least):
    facts = events.select("k", "t", "id")
    r = random.Random(2)
    starts = sorted({(k, r.randrange(300)) for k in ("hot", "a", "c") for _ in range(60)})
    versions = spark.createDataFrame([(k, s, s + r.randrange(9), f"{k}{s}") for k, s in starts], "k string, since int, until int, label string")
    versions = versions.unionByName(spark.createDataFrame([("b", 5, None, "open"), (None, 1, None, "no key"), ("b", None, None, "never")], versions.schema))
    # versions of a key must not overlap: each ends where the next begins at the latest
    w = Window.partitionBy("k").orderBy("since")
    versions = versions.withColumn("until", F.least("until", F.lead("since").over(w)))
    f, v = facts.alias("f"), versions.alias("v")
    on = (F.col("f.k") == F.col("v.k")) & (F.col("t") >= F.col("since")) & (F.col("until").isNull() | (F.col("t") < F.col("until")))
    want = f.join(v, on, "left").select("f.*", "since", "until", "label")
    got = dimensional.as_of_join(facts, versions, ["k"], "t", "since", "until", least=least)
    assert got.columns == want.columns and shown(got) == shown(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ">=" not in "".join(line for line in plan.splitlines() if "Join" in line)
