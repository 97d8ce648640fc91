"""What a load writes, counts and leaves alone; filters of keys; states of versions; streams that try again."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from siltbed.operators import history, merge, rules, touched
from siltbed.operators.rules import Rule
from siltbed.operators.shape import ColumnSpec
from siltbed.plans import job, spec
from siltbed.sources import landing
from siltbed.streaming import landing_stream as streams

ITEM = spec.EntitySpec(
    4, "shop", "item",
    [ColumnSpec("id", "id", "bigint", key=True), ColumnSpec("name", "name", "string"), ColumnSpec("at", "at", "timestamp", mark=True, hashed=False)],
    mark_type="DATETIME", rules=[Rule("copies", rules.DUPLICATE, action=rules.WARN)],
)
LOG = replace(ITEM, merging=False)
VERSIONED = replace(ITEM, history=True)


def raw(spark, *rows):
    return spark.createDataFrame([(str(i), n, f"2026-09-{d:02d} 00:00:00") for i, n, d in rows], "id string, name string, at string")


def run(spark, entity, root, n, *rows, **options):
    marks = options.pop("marks", None)
    marks = spark.createDataFrame([], "entity long, mark string") if marks is None else marks
    return job.load(entity, raw(spark, *rows), str(root), marks, f"r{n}", f"r{n}-E4", f"2026-10-{n:02d} 00:00:00", **options)


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def jobs(spark, do):
    """Spark jobs that a call runs."""
    group = f"g{id(do)}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        do()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_an_append_writes_only_its_run(spark, tmp_path):
    home = tmp_path / "target"
    first = run(spark, LOG, tmp_path, 1, (1, "a", 1), (1, "a", 1), (2, "b", 2))
    before = files(home)
    assert first.metrics == job.Metrics(3, 1, 2) and first.target.count() == 2
    second = run(spark, LOG, tmp_path, 2, (3, "c", 3))
    after = files(home)
    assert before.items() <= after.items() and {f.split("/")[-2] for f in after.keys() - before.keys()} == {"bronze_entity_run_id=r2-E4"}
    assert second.metrics == job.Metrics(1, 0, 1) and second.target.count() == 3
    again = run(spark, LOG, tmp_path, 2, (3, "c", 3), (4, "d", 4))
    assert sorted(r.id for r in again.target.collect()) == [1, 2, 3, 4]
    assert before.items() <= files(home).items()
    none = run(spark, LOG, tmp_path, 2)
    assert sorted(r.id for r in none.target.collect()) == [1, 2] and none.metrics == job.Metrics(0)
    numbers = job.load(LOG, raw(spark, (9, "n", 9)), str(tmp_path), none.marks, "7", "007", "2026-10-09 00:00:00")
    assert {r.bronze_entity_run_id for r in numbers.target.collect()} == {"r1-E4", "007"}


def test_an_append_keeps_columns_that_the_entity_lost_or_won(spark, tmp_path):
    run(spark, LOG, tmp_path, 1, (1, "a", 1))
    wide = replace(LOG, columns=[*LOG.columns, ColumnSpec("id", "twice", "int", mapping="id * 2")])
    done = run(spark, wide, tmp_path, 2, (2, "b", 2))
    assert {(r.id, r.twice) for r in done.target.collect()} == {(1, None), (2, 4)}
    back = run(spark, LOG, tmp_path, 3, (3, "c", 3))
    assert {(r.id, r.twice) for r in back.target.collect()} == {(1, None), (2, 4), (3, None)}


def test_a_load_counts_as_it_writes(spark, tmp_path):
    run(spark, ITEM, tmp_path, 1, (1, "a", 1), (2, "b", 1), (3, "c", 1))
    rows = [(1, "a", 2), (2, "B", 2), (2, "old", 1), (4, "d", 2)]
    done = []
    n = jobs(spark, lambda: done.append(run(spark, ITEM, tmp_path, 2, *rows)))
    assert done[0].metrics == job.Metrics(read=4, rejected=1, inserted=1, updated=1, deleted=0, unchanged=1)
    assert n < 30
    counted = [(r.rule_type, r.status) for r in done[0].report.collect()]
    assert ("STAGING_INTEGRITY", "PASSED") in counted
    n = jobs(spark, lambda: run(spark, LOG, tmp_path / "log", 1, *rows))
    assert n < 30


def test_staging_that_lacks_rows_stops_the_load(spark, tmp_path):
    stopped = run(spark, ITEM, tmp_path, 1, (1, "a", 1), expected_rows=2)
    assert not stopped.succeeded and stopped.target is None and stopped.metrics is None
    assert [(r.rule_type, r.failed_row_count) for r in stopped.report.where("status = 'FAILED'").collect()] == [("STAGING_INTEGRITY", 1)]


def test_rows_that_no_key_of_the_batch_touches_stay_out_of_the_join(spark):
    target = spark.range(0, 20000).select("id", F.lit("h").alias(merge.HASH), F.lit("ACTIVE").alias(merge.STATUS), F.lit("old").alias("name"))
    batch = spark.range(19990, 20020).select(F.col("id").cast("int"), F.lit("i").alias(merge.HASH), F.lit("ACTIVE").alias(merge.STATUS), F.lit("new").alias("name"))
    found = touched.key_filter(batch, ["id"], target=target)
    may, rest = found.part(target)
    assert may.count() + rest.count() == 20000 and {r.id for r in may.where("id >= 19990").collect()} == set(range(19990, 20000))
    assert 10 <= may.count() < 10 + 20000 // 20  # a few false positives, which the join sorts out
    plain, split = merge.merge(target, batch, ["id"]), merge.merge(target, batch, ["id"], touched=found)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, plain.collect()))
    everything = touched.KeyFilter(("id",), found.types, spark.createDataFrame([(0, -1)], "_word long, _bits long"), 1)
    assert everything.part(target)[0].count() == 20000  # nothing but false positives
    assert sorted(map(tuple, merge.merge(target, batch, ["id"], touched=everything).collect())) == sorted(map(tuple, plain.collect()))
    assert touched.key_filter(batch, ["id"], most=29) is None
    told = merge.merge(target, batch, ["id"], touched=found, told=True, detect=False)
    assert {r["_action"]: r["count"] for r in told.groupBy("_action").count().collect()} == {"KEEP": 19990, "UPDATE": 10, "INSERT": 20}


def test_what_a_merge_exchanges_follows_the_batch(spark, tmp_path):
    for n, name in ((200_000, "target"), (50, "batch")):
        spark.range(n).select("id", F.sha2(F.col("id").cast("string"), 256).alias(merge.HASH), F.lit("ACTIVE").alias(merge.STATUS)).write.parquet(f"{tmp_path}/{name}")
    target, batch = (spark.read.parquet(f"{tmp_path}/{x}") for x in ("target", "batch"))

    def exchanged(df):
        """Rows that the query wrote for its exchanges."""
        df.collect()
        out, todo = 0, [df._jdf.queryExecution().executedPlan().executedPlan()]
        while todo:
            node = todo.pop()
            if "QueryStage" in node.nodeName():
                todo.append(node.plan())
            elif node.nodeName() == "Exchange":
                out += node.metrics().get("shuffleRecordsWritten").get().value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
        return out

    keys = touched.key_filter(batch, ["id"])
    assert exchanged(merge.merge(target, batch, ["id"])) > 200_000
    assert exchanged(merge.merge(target, batch, ["id"], touched=keys)) < 20_000


def test_closed_versions_are_neither_read_nor_written_again(spark, tmp_path):
    home = tmp_path / "target"
    run(spark, VERSIONED, tmp_path, 1, (1, "a", 1), (2, "b", 1), (2, "c", 2), (2, "c", 2))
    first = {f for f in files(home) if "state=closed" in f}
    done = run(spark, VERSIONED, tmp_path, 2, (1, "z", 5), (3, "n", 5))
    assert done.metrics == job.Metrics(2, 0, 2, 1, 0, 0)
    later = {f: t for f, t in files(home).items() if "state=closed" in f}
    assert first < later.keys() and len(first) == 1
    got = sorted((r.id, r.name, r.bronze_is_current) for r in done.target.collect())
    assert got == [(1, "a", False), (1, "z", True), (2, "b", False), (2, "c", True), (3, "n", True)]
    # the same by the function that sees all versions
    again = run(spark, VERSIONED, tmp_path, 3, (1, "z", 5), (3, "n", 5))
    assert sorted(map(str, again.target.collect())) == sorted(map(str, done.target.collect())) and again.metrics.inserted == 0
    now = landing.read_states(spark, str(home), history.STATE, history.NOW, states=[history.NOW])
    assert {f.split("state=")[1].split("/")[0] for f in now.inputFiles()} >= {"current"}
    scan = [line for line in now._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line][0]
    assert "state" in scan.split("PartitionFilters")[1]
    now.collect()
    assert now._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
    read = now.select(F.input_file_name().alias("f")).distinct().collect()
    assert len(read) >= 1 and all("state=current" in r.f and "v=00000002" in r.f for r in read)


def test_versions_of_one_instant_come_once(spark, tmp_path):
    rows = [(1, "a", 1), (1, "b", 1), (1, "c", 1)]
    first = run(spark, VERSIONED, tmp_path, 1, *rows)
    again = run(spark, VERSIONED, tmp_path, 2, *rows)
    assert first.target.count() == again.target.count() == 3 and again.metrics.inserted == 0
    assert any("state=instant" in f for f in files(tmp_path / "target"))


def test_states_give_what_one_table_gives(spark, tmp_path):
    import random

    r = random.Random(3)
    target = spark.createDataFrame([], job.table_schema(VERSIONED.columns, True))
    for n in (1, 2, 3, 4):
        rows = [(r.randrange(8), r.choice("AB"), r.randrange(1, 4 + 6 * n)) for _ in range(25)]
        done = run(spark, VERSIONED, tmp_path, n, *rows)
        whole = job.process(VERSIONED, raw(spark, *rows), target, f"r{n}", f"r{n}-E4", f"2026-10-{n:02d} 00:00:00").target
        target = spark.createDataFrame(whole.collect(), whole.schema)
        assert sorted(map(str, done.target.select(*target.columns).collect())) == sorted(map(str, target.collect()))


def test_a_write_that_failed_is_written_anew_and_old_snapshots_go(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "id int")
    root = str(tmp_path / "snap")
    landing.write_snapshot(df, root)
    os.makedirs(f"{root}/v=00000001/_temporary")
    assert landing.read_snapshot(spark, root).count() == 1
    landing.write_snapshot(df.union(df), root)
    assert landing.snapshot_versions(spark, root) == [0, 1] and landing.read_snapshot(spark, root).count() == 2
    landing.write_snapshot(df, root)
    assert len(landing.expire_snapshots(spark, root, 1)) == 2 and landing.snapshot_versions(spark, root) == [2]
    for n in (1, 2, 3):
        done = run(spark, VERSIONED, tmp_path / "h", n, (1, f"n{n}", n), keep=1)
    assert done.target.count() == 3 and len({f for f in files(tmp_path / "h" / "target") if "state=current" in f}) == 1


def test_metadata_of_methods_and_masks(spark):
    assert replace(ITEM, change_detection="NONE").problems() == []
    wrong = replace(VERSIONED, change_detection="NONE", mask_names={"name": "nope", "id": "odd"}, catalogue={"odd": spec.MaskRule("ODD")})
    assert sorted(wrong.problems()) == ["HISTORY needs change detection HASH", "column id has a mask of unknown type 'ODD'", "column name names unknown mask rule nope"]
    assert replace(ITEM, change_detection="SOME").problems() == ["unknown change detection 'SOME'"]
    named = replace(ITEM, mask_names={"name": "hide"}, catalogue={"hide": spec.MaskRule("REDACT")})
    assert named.problems() == [] and set(named.all_masks) == {"name"}
    with pytest.raises(ValueError, match="change detection"):
        run(spark, replace(ITEM, change_detection="SOME"), "/nowhere", 1)


def test_named_masks_apply_and_masked_keys_still_match(spark, tmp_path):
    masks = {"hide": spec.MaskRule("TOKENIZE")}
    text_key = replace(ITEM, columns=[ColumnSpec("id", "id", "string", key=True), *ITEM.columns[1:]], mask_names={"id": "hide", "name": "hide"}, catalogue=masks)
    one = run(spark, text_key, tmp_path, 1, (1, "a", 1), (2, "b", 1), masking=True, salts={"id": "s"})
    two = run(spark, text_key, tmp_path, 2, (1, "a", 2), (2, "c", 2), masking=True, salts={"id": "s"})
    assert all(r.id.startswith("TKN_") and r.name.startswith("TKN_") for r in two.target.collect())
    assert one.metrics.inserted == 2 and two.metrics == job.Metrics(2, 0, 0, 1, 0, 1)


def test_override_extracts_bind_the_mark(spark):
    df = spark.createDataFrame([(1, "a"), (5, "it's"), (9, "z")], "n int, s string")
    get = lambda statement, kind, mark: sorted(r.n for r in landing.extract_override(spark, statement, kind, mark, t=df).collect())
    assert get("SELECT n FROM {t} WHERE n > {watermark}", "NUMERIC", "1") == [5, 9]
    assert get("SELECT n FROM {t} WHERE n > {watermark} OR n = {watermark}", "NUMERIC", "4.5") == [5, 9]
    assert get("SELECT n FROM {t} WHERE n > {watermark}", "NUMERIC", None) == [1, 5, 9]
    assert get("SELECT n FROM {t} WHERE s >= {watermark}", "STRING", "it's") == [5, 9]
    assert get("SELECT n FROM {t} WHERE s > {watermark}", "STRING", "x' OR '1' = '1") == [9]
    assert get("SELECT n FROM {t} WHERE timestamp_ntz'2000-01-01' > {watermark}", "DATETIME", None) == [1, 5, 9]
    with pytest.raises(ValueError):
        get("SELECT n FROM {t}", "OTHER", None)


def test_an_override_reaches_the_scan(spark, tmp_path):
    spark.range(100).select("id", F.timestamp_micros(F.col("id") * 10**12).cast("timestamp_ntz").alias("at")).write.parquet(f"{tmp_path}/t")
    for column, kind, mark in (("id", "NUMERIC", "42"), ("at", "DATETIME", "1970-06-01 00:00:00.000000")):
        df = landing.extract_override(spark, f"SELECT id FROM {{t}} WHERE {column} > {{watermark}}", kind, mark, t=spark.read.parquet(f"{tmp_path}/t"))
        assert f"GreaterThan({column}" in df._jdf.queryExecution().executedPlan().toString()


def test_a_stream_loads_whole_batches_and_tries_again(spark, tmp_path):
    root = str(tmp_path)

    def land(n, *rows):
        raw(spark, *rows).coalesce(1).write.json(f"{root}/in/part={n}")

    def go(entity):
        stream = streams.landing_stream(spark, f"{root}/in/*", ["id", "name", "at"])
        q = streams.load_stream(entity, stream, f"{root}/load", f"{root}/checkpoint", lambda run: "2026-10-01 00:00:00")
        q.awaitTermination()

    def target():
        return sorted((r.id, r.name, r.bronze_run_id) for r in job.current_target(ITEM, spark, f"{root}/load/target").collect())

    land(0, (1, "a", 1), (2, "b", 2))
    go(ITEM)
    assert target() == [(1, "a", "batch-00000000"), (2, "b", "batch-00000000")]
    assert [tuple(r) for r in streams.read_marks(spark, f"{root}/load").collect()] == [(4, "2026-09-02 00:00:00.000000")]
    land(1, (2, "B", 3), (3, "c", 3))
    with pytest.raises(Exception, match="none"):
        go(replace(ITEM, rules=[Rule("none", rules.CUSTOM, expression="id < 3")]))
    assert len(target()) == 2  # nothing was written, the file is not taken
    with pytest.raises(Exception, match="late"):
        go(replace(ITEM, rules=[Rule("late", rules.CUSTOM, expression="id < 3", stage=rules.POST)]))
    assert len(target()) == 3  # written, but the mark has stayed
    assert [r.mark for r in streams.read_marks(spark, f"{root}/load").collect()] == ["2026-09-02 00:00:00.000000"]
    go(ITEM)
    assert target() == [(1, "a", "batch-00000000"), (2, "B", "batch-00000001"), (3, "c", "batch-00000001")]
    assert [r.mark for r in streams.read_marks(spark, f"{root}/load").collect()] == ["2026-09-03 00:00:00.000000"]
