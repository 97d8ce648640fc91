"""Known results of loads, rules, masks, marks and roll-ups, and algebraic properties."""

import datetime as dt
import decimal
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from siltbed.functions import marks, masking, messages
from siltbed.functions.canonical import canonical, quoted, record_hash
from siltbed.functions.masking import MaskRule
from siltbed.operators import audit, checks, rules, shape
from siltbed.operators.rules import Rule
from siltbed.operators.shape import ColumnSpec
from siltbed.plans import job, spec
from siltbed.sources import landing

CUSTOMER = spec.EntitySpec(
    1, "crm", "customer",
    [ColumnSpec("CustomerId", "CustomerId", "int", key=True), ColumnSpec("FirstName", "FirstName", "string"), ColumnSpec("Email", "Email", "string"), ColumnSpec("ModifiedDate", "ModifiedDate", "timestamp", mark=True, hashed=False)],
    history=True, mark_type="DATETIME", rules=[Rule("mark", rules.MARK), Rule("builtin_duplicate", rules.DUPLICATE, action=rules.WARN)],
    masks={"Email": MaskRule("HASH", "EMAIL")},
)
PRODUCT = spec.EntitySpec(
    2, "crm", "product",
    [ColumnSpec("ProductId", "ProductId", "int", key=True), ColumnSpec("ProductName", "ProductName", "string"), ColumnSpec("ListPrice", "ListPrice", "decimal(18,2)"), ColumnSpec("ModifiedDate", "ModifiedDate", "timestamp", mark=True, hashed=False)],
    mark_type="DATETIME", rules=[Rule("price", rules.CUSTOM, expression="ListPrice IS NULL OR ListPrice >= 0")],
)
TERRITORY = spec.EntitySpec(3, "crm", "territory", [ColumnSpec("Id", "Id", "int", key=True), ColumnSpec("Name", "Name", "string")], full_load=True, soft_delete=True)


def load(spark, entity, rows, target, run, now, **options):
    raw = spark.createDataFrame(rows, ", ".join(f"{c.source} string" for c in entity.columns))
    if target is None:
        target = spark.createDataFrame([], shape.table_schema(entity.columns, entity.history))
    out = job.process(entity, raw, target, run, f"{run}-E{entity.entity_id}", now, **options)
    return out, None if out.target is None else spark.createDataFrame(out.target.collect(), out.target.schema)


def test_history_initial_incremental_replay(spark):
    one = [("100", "Ann", "ann@x.com", "2026-09-01 00:00:00")] * 2 + [("101", "Bob", None, "2026-09-01 00:00:00")]
    out, target = load(spark, CUSTOMER, one, None, "r1", "2026-09-02 00:00:00", masking=True, salts={"Email": "s"})
    rows = target.collect()
    assert len(rows) == 2 and all(r.bronze_is_current for r in rows)
    assert not any(r.Email and "ann@" in r.Email for r in rows) and {bool(r.Email) for r in rows} == {True, False}
    assert out.batch_mark.select(marks.mark_text(F.col("batch_mark"), "DATETIME")).first()[0] == "2026-09-01 00:00:00.000000"
    two = [("100", "Anne", "ann@x.com", "2026-09-10 00:00:00"), ("101", "Bob", None, "2026-09-10 00:00:00"), ("102", "Cy", None, "2026-09-10 00:00:00")]
    _, target = load(spark, CUSTOMER, two, target, "r2", "2026-09-11 00:00:00", masking=True, salts={"Email": "s"})
    by = {}
    for r in target.collect():
        by.setdefault(r.CustomerId, []).append(r)
    assert {k: len(v) for k, v in by.items()} == {100: 2, 101: 1, 102: 1}
    assert [r.bronze_valid_to for r in by[100] if not r.bronze_is_current] == [dt.datetime(2026, 9, 10)]
    assert sum(r.bronze_is_current for v in by.values() for r in v) == 3
    _, again = load(spark, CUSTOMER, two, target, "r3", "2026-09-12 00:00:00", masking=True, salts={"Email": "s"})
    assert again.count() == target.count()


def test_same_instant_versions_repeat_without_change(spark):
    rows = [("1", "A", None, "2026-09-01 00:00:00"), ("1", "B", None, "2026-09-01 00:00:00")]
    _, target = load(spark, CUSTOMER, rows, None, "r1", "2026-09-02 00:00:00")
    _, again = load(spark, CUSTOMER, rows, target, "r2", "2026-09-03 00:00:00")
    assert target.count() == again.count() == 2
    assert again.where("bronze_is_current").count() == 1


def test_merge_initial_rule_change(spark):
    one = [("1", "Pen", "1.00", "2026-09-01 00:00:00"), ("2", "Ink", "2.00", "2026-09-01 00:00:00")]
    _, target = load(spark, PRODUCT, one, None, "r1", "2026-09-02 00:00:00")
    assert target.count() == 2
    bad, none = load(spark, PRODUCT, [("1", "Pen", "-5.00", "2026-09-03 00:00:00")], target, "r2", "2026-09-03 00:00:00")
    assert none is None and bad.batch_mark is None
    assert {r.rule_name for r in bad.report.where("status = 'FAILED'").collect()} == {"price"}
    _, target = load(spark, PRODUCT, [("1", "Pen v2", "1.00", "2026-09-04 00:00:00"), ("2", "Ink", "2.00", "2026-09-04 00:00:00")], target, "r3", "2026-09-05 00:00:00")
    by = {r.ProductId: r for r in target.collect()}
    assert by[1].ProductName == "Pen v2" and by[1].bronze_created_datetime < by[1].bronze_updated_datetime
    assert by[2].bronze_updated_datetime == dt.datetime(2026, 9, 2)


def test_soft_delete_and_revival(spark):
    _, target = load(spark, TERRITORY, [("1", "N"), ("2", "S")], None, "r1", "2026-09-01 00:00:00")
    _, target = load(spark, TERRITORY, [("1", "N")], target, "r2", "2026-09-02 00:00:00")
    assert {r.Id: r.bronze_record_status for r in target.collect()} == {1: "ACTIVE", 2: "DELETED"}
    _, target = load(spark, TERRITORY, [("1", "N"), ("2", "S")], target, "r3", "2026-09-03 00:00:00")
    assert {r.Id: r.bronze_record_status for r in target.collect()} == {1: "ACTIVE", 2: "ACTIVE"}


def test_target_only_columns_survive(spark):
    _, target = load(spark, TERRITORY, [("1", "N")], None, "r1", "2026-09-01 00:00:00")
    target = target.withColumn("note", F.lit("kept"))
    _, target = load(spark, TERRITORY, [("1", "M"), ("2", "S")], target, "r2", "2026-09-02 00:00:00")
    assert {r.Id: (r.Name, r.note) for r in target.collect()} == {1: ("M", "kept"), 2: ("S", None)}


def test_canonical_values_and_hashes(spark):
    df = spark.createDataFrame([(None, dt.datetime(2026, 9, 1, 10, 0, 0, 5), dt.date(2026, 9, 1), True, decimal.Decimal("12.5"), b"\x01\xff", [1, 2])], "n string, t timestamp, d date, b boolean, x decimal(18,2), raw binary, a array<int>")
    assert list(df.select(*[canonical(df, c) for c in df.columns]).first()) == ["\\N", "2026-09-01T10:00:00.000005", "2026-09-01", "true", "12.50", "01ff", "[1,2]"]
    two = spark.createDataFrame([(None, "x"), ("", "x"), ("N", "x"), ("ab", ""), ("a", "b")], "a string, b string")
    assert two.select(record_hash(two, ["a", "b"])).distinct().count() == 5
    assert quoted("a`b") == "`a``b`"
    assert df.select(record_hash(df, [])).first()[0] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_row_counts_and_rollup(spark):
    df = spark.createDataFrame([(150.0, 100.0), (10.0, None), (5.0, 0.0), (0.0, 0.0)], "c double, p double")
    assert [r[0] for r in df.select(rules.row_count_change(F.col("c"), F.col("p"))).collect()] == [50.0, None, 100.0, 0.0]
    cases = {"": "SUCCEEDED", "SS": "SUCCEEDED", "F": "FAILED", "SF": "PARTIAL_SUCCESS", "FC": "FAILED", "SC": "CANCELLED"}
    df = spark.createDataFrame([(c.count("S"), c.count("F"), c.count("C"), w) for c, w in cases.items()], "s int, f int, c int, w string")
    assert df.where(audit.rollup_status(F.col("s"), F.col("f"), F.col("c")) != F.col("w")).count() == 0


def test_masks(spark):
    df = spark.createDataFrame([("1234567",), ("123",), (None,)], "v string")
    one = lambda rule: [r[0] for r in df.select(masking.masked(df, "v", rule)).collect()]
    assert one(MaskRule("MASK")) == ["***4567", "", None]
    assert one(MaskRule("MASK", parameters={"keep_last": 0, "mask_char": "x"})) == ["xxxxxxx", "xxx", None]
    assert one(MaskRule("REDACT")) == ["REDACTED", "REDACTED", None] and one(MaskRule("NULLIFY")) == [None] * 3
    for wrong in (MaskRule("CUSTOM", parameters={"expression": "1"}), MaskRule("NOPE")):
        with pytest.raises(ValueError):
            masking.masked(df, "v", wrong)
    with pytest.raises(ValueError):
        masking.masked(df.select(F.lit(1).alias("v")), "v", MaskRule("HASH"))
    assert masking.anonymise(df, {"v": MaskRule("REDACT")}, enabled=False) is df


def test_messages(spark):
    df = spark.createDataFrame([("bad 'secret value' of ann@x.org, id 12345678, 'ab'", "HYT00", True), ("Login failed after timeout", "42000", False), ("socket closed", None, True), ("odd", "1:1205", True), ("odd", None, False), (None, None, False)], "m string, c string, w boolean")
    assert df.select(messages.scrubbed(F.col("m"))).first()[0] == "bad '<redacted>' of <redacted-email>, id <redacted-number>, 'ab'"
    assert df.where(messages.is_retryable(F.col("c"), F.col("m")) != F.col("w")).count() == 0
    assert df.select(messages.error_code(F.lit("08S01 link (10054) down"))).first()[0] == "08S01:10054"


def test_marks(spark):
    df = spark.createDataFrame([("2026-09-01T10:00:00.000005",), ("2026-09-01 10:00:00",), ("2026-09-01",), ("",), ("junk",)], "v string")
    got = [r[0] for r in df.select(marks.parsed_mark(F.col("v"), "DATETIME")).collect()]
    assert got == [dt.datetime(2026, 9, 1, 10, 0, 0, 5), dt.datetime(2026, 9, 1, 10), dt.datetime(2026, 9, 1), None, None]
    text = lambda v: spark.sql(f"select {v} as v").select(marks.mark_text(F.col("v"), "NUMERIC")).first()[0]
    assert [text("100"), text("1.50BD"), text("0"), text("-2.000BD")] == ["100", "1.5", "0", "-2"]


def test_rule_planning_and_gate(spark):
    names = [r.type for r in rules.effective_rules([Rule("d", rules.DUPLICATE), Rule("t", rules.TYPE, "a")], True)]
    assert names == [rules.PK_NULL, rules.MISSING, rules.TYPE, rules.DUPLICATE, rules.TYPE]
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, v string")
    found = rules.report(df, [Rule("d", rules.DUPLICATE, action=rules.WARN), Rule("m", rules.MANDATORY, "v")], ["k"])
    assert {r.rule_name: (r.status, r.failed_row_count) for r in found.collect()} == {"d": ("WARNING", 1), "m": ("FAILED", 1)}
    assert rules.blocks(found) and not rules.blocks(found, False)
    empty = rules.report(df.limit(0), [Rule("d", rules.DUPLICATE), Rule("m", rules.MANDATORY, "v")], ["k"])
    assert {r.status for r in empty.collect()} == {"PASSED"}


def test_landing_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    path = landing.write_landing(df, str(tmp_path), "crm", "t", "20260901000000")
    assert sorted((r.id, r.v, r.w) for r in landing.read_landing(spark, path, ["id", "v", "w"]).collect()) == [("1", "a", None), ("2", None, None)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        landing.write_landing(df, str(tmp_path), "crm", "t", "20260901000000")
    for bad in (("..", "t", "20260901000000"), ("a/b", "t", "20260901000000"), ("a", "t", "2026")):
        with pytest.raises(ValueError):
            landing.landing_path(*bad)
    files = spark.createDataFrame([(f"t_{s}.json",) for s in ("20260902000000", "20260901000000", "20260903000000")] + [("t_1.json",), ("u_20260901000000.json",)], "file_name string")
    assert [r.stamp for r in landing.replay_files(files, "t", since="20260902000000").collect()] == ["20260902000000", "20260903000000"]
    assert [r.stamp for r in landing.replay_files(files, "t").collect()] == ["20260903000000"]


def test_staging_and_snapshots(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    path = str(tmp_path / "stage")
    landing.stage(df, path, "r1")
    assert landing.staged(spark.read.parquet(path), "r1").count() == 2
    landing.truncate(spark, path)
    assert spark.read.parquet(path).count() == 0 and "_staging_run_id" in spark.read.parquet(path).columns
    root = str(tmp_path / "snap")
    assert landing.read_snapshot(spark, root) is None
    landing.write_snapshot(df, root)
    landing.write_snapshot(landing.read_snapshot(spark, root).where("id = 2"), root)
    assert [r.id for r in landing.read_snapshot(spark, root).collect()] == [2] and landing.snapshot_versions(spark, root) == [0, 1]


def test_specs(spark):
    assert [s.strategy for s in (CUSTOMER, PRODUCT, TERRITORY)] == [spec.HISTORY, spec.MERGE, spec.MERGE]
    plain = lambda **k: spec.EntitySpec(9, "s", "t", [ColumnSpec("a", "a", "int")], merging=False, **k)
    assert (plain(full_load=True).strategy, plain().strategy) == (spec.REPLACE, spec.APPEND)
    assert PRODUCT.hash_columns == ["ProductName", "ListPrice"]
    wrong = spec.EntitySpec(9, "s", "t", [ColumnSpec("a", "a", "int"), ColumnSpec("b", "A", "int")], rules=[Rule("r", rules.CUSTOM, "zz")])
    assert len(wrong.problems()) == 5
    df = spark.createDataFrame([(1, "g", True), (2, "g", False)], "entity_id int, load_group string, is_active boolean")
    assert spec.active_entities(df, [1]).count() == 1
    with pytest.raises(ValueError):
        spec.active_entities(df, [1, 2])


def test_properties_of_history_and_merge(spark):
    import random

    r = random.Random(0)
    rows = lambda lo, hi: [(str(r.randrange(6)), r.choice("AB"), None, f"2026-09-{r.randrange(lo, hi):02d} 00:00:00") for _ in range(30)]
    _, target = load(spark, CUSTOMER, rows(1, 10), None, "r1", "2026-10-01 00:00:00")
    batch = rows(5, 20)
    _, once = load(spark, CUSTOMER, batch, target, "r2", "2026-10-02 00:00:00")
    _, twice = load(spark, CUSTOMER, batch, once, "r2", "2026-10-02 00:00:00")
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    by = {}
    for x in once.collect():
        by.setdefault(x.CustomerId, []).append(x)
    for v in by.values():
        assert sum(x.bronze_is_current for x in v) == 1
        v.sort(key=lambda x: (x.bronze_valid_from, x.bronze_valid_to or dt.datetime.max))
        assert all(a.bronze_valid_to == b.bronze_valid_from for a, b in zip(v, v[1:]))


def test_visible_rows_without_access(spark):
    df = spark.createDataFrame([(1, "x")], "k int, s string")
    access = spark.createDataFrame([("ann", False, None)], "user_name string, is_active boolean, k int")
    assert checks.visible_rows(df, access, "ann", {"k": "k"}).count() == 0
    assert checks.visible_rows(df, access.withColumn("is_active", F.lit(True)), "ann", {"k": "k"}).count() == 1


def test_a_whole_load_reads_the_raw_batch_once(spark, tmp_path):
    rows = spark.createDataFrame([("1", "Pen", "1.00", "2026-09-01 00:00:00"), ("2", "Ink", "x", "2026-09-02 00:00:00")], "ProductId string, ProductName string, ListPrice string, ModifiedDate string")
    rows.write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    marks_ = spark.createDataFrame([], "entity long, mark string")
    stopped = job.load(PRODUCT, raw, f"{tmp_path}/load", marks_, "r1", "r1-E2", "2026-09-03 00:00:00")
    assert stopped.target is None and not stopped.succeeded and stopped.marks.isEmpty()
    assert {(r.rule_type, r.failed_row_count) for r in stopped.report.where("status = 'FAILED'").collect()} == {("DATA_TYPE_MISMATCH", 1)}
    lenient = replace(PRODUCT, rules=[Rule("types", rules.TYPE, action=rules.WARN), Rule("few", rules.CUSTOM, expression="ProductId < 2", stage=rules.POST, action=rules.WARN)])
    done = job.process(lenient, raw, spark.createDataFrame([], shape.table_schema(PRODUCT.columns)), "r2", "r2-E2", "2026-09-03 00:00:00", staging=f"{tmp_path}/staging")
    for frame in (done.target, done.report, done.batch_mark):
        files = frame.inputFiles()
        assert files and all("/staging/" in f for f in files)
    out = job.load(lenient, raw, f"{tmp_path}/load", marks_, "r2", "r2-E2", "2026-09-03 00:00:00")
    assert out.succeeded and out.target.count() == 2
    assert [(r.rule_name, r.failed_row_count) for r in out.post.collect()] == [("few", 1)]
    assert [tuple(r) for r in out.marks.collect()] == [(2, "2026-09-02 00:00:00.000000")]
    hard = replace(lenient, rules=[*lenient.rules, Rule("none", rules.CUSTOM, expression="false", stage=rules.POST)])
    late = job.load(hard, raw, f"{tmp_path}/load", marks_, "r3", "r3-E2", "2026-09-04 00:00:00")
    assert not late.succeeded and late.marks.isEmpty()  # what a POST rule finds leaves the mark where it was


def test_control_sets(spark):
    assert spec.set_problems([PRODUCT, CUSTOMER]) == []
    found = spec.set_problems([PRODUCT, replace(PRODUCT, rules=[Rule("u", rules.UNIQUE, columns=("nowhere",)), Rule("s", rules.MARK, stage="LATE")])])
    assert len(found) == 4 and any("id 2 occurs 2 times" in p for p in found)


def test_visible_rows_by_patterns(spark):
    df = spark.createDataFrame([(i, i % 3, i % 2) for i in range(12)], "id int, a int, b int")
    access = spark.createDataFrame([("ann", True, 0, None), ("ann", True, None, 1), ("ann", True, 0, 1), ("ann", False, None, None), ("bob", True, None, None), ("cy", True, 2, 0), ("cy", True, 2, 0)], "user_name string, is_active boolean, a int, b int")
    on = {"a": "a", "b": "b"}
    seen = lambda u: sorted(r.id for r in checks.visible_rows(df, access, u, on).collect())
    assert seen("ann") == [i for i in range(12) if i % 3 == 0 or i % 2 == 1]
    assert seen("bob") == list(range(12)) and seen("cy") == [2, 8] and seen("dee") == []
