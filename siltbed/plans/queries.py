"""The registered queries of the ingestion operators, each beside its SQL.

Batches and targets are derived from the given tables, in the query and in its
SQL alike; all of them read whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions import marks
from siltbed.functions.canonical import canonical, record_hash
from siltbed.operators import checks, dedup, history, merge, rules, shape, state
from siltbed.operators.shape import ColumnSpec
from siltbed.plans import spec
from siltbed.sources import landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


class Tables:
    """The tables of a folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


MONEY = "decimal(18,2)"
NOW = "2024-02-01 00:00:00"
text_time = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")

# ---- sources -----------------------------------------------------------------


def _scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, for queries that write files and read them back."""
    import re
    import tempfile
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="siltbed-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@query("landing_json_scan", "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, props, CAST(NULL AS VARCHAR) AS absent FROM events")
def landing_json_scan(spark, d):
    root = _scratch(spark, "landing")
    path = landing.write_landing(Tables(spark, d).events, root, "app", "events", "20240201000000")
    return landing.read_landing(spark, path, ["event_id", "user_id", "event_type", "props", "absent"])


@query("landing_json_sink", "SELECT CASE WHEN event_id % 2 = 0 THEN '20240201000000' ELSE '20240202000000' END AS stamp, count(*) AS n FROM events GROUP BY 1")
def landing_json_sink(spark, d):
    root = _scratch(spark, "landing")
    e = Tables(spark, d).events
    for half, stamp in ((0, "20240201000000"), (1, "20240202000000")):
        landing.write_landing(e.where(F.col("event_id") % 2 == half), root, "app", "events", stamp)
    files = spark.read.schema("event_id string").json(f"{root}/app/events/*")
    stamp = F.regexp_extract(F.col("_metadata.file_path"), r"events_(\d{14})\.json", 1)
    return files.groupBy(stamp.alias("stamp")).agg(F.count("*").alias("n"))


@query("landing_path_columns", "SELECT doc_id, CASE WHEN regexp_full_match(source, '[A-Za-z0-9_.\\-]+') AND source NOT IN ('.', '..') THEN source || '/' || lang || '/' || lang || '_20240201000000.json' END AS landing_path FROM documents")
def landing_path_columns(spark, d):
    return Tables(spark, d).documents.select("doc_id", landing.landing_paths(F.col("source"), F.col("lang"), F.lit("20240201000000")).alias("landing_path"))


_FILES_SQL = "SELECT event_id, 'events_' || strftime(ts, '%Y%m%d%H%M%S') || CASE WHEN event_id % 5 = 0 THEN '.csv' ELSE '.json' END AS file_name FROM events"


def _files(t):
    return t.events.select("event_id", F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMddHHmmss"), F.when(F.col("event_id") % 5 == 0, ".csv").otherwise(".json")).alias("file_name"))


@query("landing_ts_parse", f"WITH f AS ({_FILES_SQL}) SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN substr(file_name, 8, 14) END AS stamp FROM f")
def landing_ts_parse(spark, d):
    return _files(Tables(spark, d)).select("event_id", landing.stamp_of(F.col("file_name"), "events").alias("stamp"))


@query("replay_selection", f"WITH f AS ({_FILES_SQL}) SELECT event_id, file_name, substr(file_name, 8, 14) AS stamp FROM f WHERE file_name LIKE '%.json' AND substr(file_name, 8, 14) >= '20240115000000'")
def replay_selection(spark, d):
    return landing.replay_files(_files(Tables(spark, d)), "events", since="20240115000000")


_STAGED = "SELECT *, 'run-' || (l_orderkey % 3) AS _staging_run_id FROM lineitem"


def _staged(t):
    return t.lineitem.withColumn(landing.RUN_COLUMN, F.concat(F.lit("run-"), F.col("l_orderkey") % 3))


@query("staging_scan_run", f"SELECT l_orderkey, l_linenumber, _staging_run_id FROM ({_STAGED}) WHERE _staging_run_id = 'run-1'")
def staging_scan_run(spark, d):
    return landing.staged(_staged(Tables(spark, d)), "run-1").select("l_orderkey", "l_linenumber", landing.RUN_COLUMN)


@query("staging_integrity", f"SELECT count(*) AS total_rows, count(*) FILTER (_staging_run_id = 'run-1') AS run_rows, count(*) = count(*) FILTER (_staging_run_id = 'run-1') AS is_consistent FROM ({_STAGED})")
def staging_integrity(spark, d):
    t = _staged(Tables(spark, d))
    return rules.staging_integrity(t, "run-1", 0).withColumn("is_consistent", F.col("total_rows") == F.col("run_rows"))


@query("incremental_extract_datetime", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'")
def incremental_extract_datetime(spark, d):
    return landing.extract(Tables(spark, d).orders, ["o_orderkey", "o_custkey", "o_orderdate"], "o_orderdate", "1998-01-01 00:00:00")


@query("incremental_extract_numeric", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 7500 AND o_orderstatus <> 'P'")
def incremental_extract_numeric(spark, d):
    return landing.extract(Tables(spark, d).orders, ["o_orderkey", "o_orderstatus"], "o_orderkey", 7500, extra=F.col("o_orderstatus") != "P")


@query("incremental_extract_string", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority > '3'")
def incremental_extract_string(spark, d):
    return landing.extract(Tables(spark, d).orders, ["o_orderkey", "o_orderpriority"], "o_orderpriority", "3")


#: Statements of the metadata's own, as they stand there, and the same in SQL with the literal.
_OVERRIDE = "SELECT o_orderkey, {0} AS mark FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey WHERE {0} > {{watermark}} AND c_acctbal > 0"
_OVERRIDE_SQL = "SELECT o_orderkey, {0} AS mark FROM orders JOIN customer ON o_custkey = c_custkey WHERE {0} > {1} AND c_acctbal > 0"


def _override(spark, d, column, kind, mark):
    t = Tables(spark, d)
    return landing.extract_override(spark, _OVERRIDE.format(column), kind, mark, orders=t.orders, customer=t.customer)


@query("incremental_extract_override_datetime", _OVERRIDE_SQL.format("o_orderdate", "TIMESTAMP '1998-01-01'"))
def incremental_extract_override_datetime(spark, d):
    return _override(spark, d, "o_orderdate", marks.DATETIME, "1998-01-01 00:00:00.000000")


@query("incremental_extract_override_numeric", _OVERRIDE_SQL.format("o_orderkey", "7500"))
def incremental_extract_override_numeric(spark, d):
    return _override(spark, d, "o_orderkey", marks.NUMERIC, "7500")


@query("incremental_extract_override_string", _OVERRIDE_SQL.format("o_orderpriority", "'3'"))
def incremental_extract_override_string(spark, d):
    return _override(spark, d, "o_orderpriority", marks.STRING, "3")


@query("incremental_extract_override_floor", " UNION ALL ".join("SELECT o_orderkey, CAST({0} AS VARCHAR) AS mark FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0".format(c) for c in ("strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", "o_orderkey", "o_orderpriority")))
def incremental_extract_override_floor(spark, d):
    """Without a mark the floor of each kind is bound: all rows."""
    text = {"o_orderdate": F.date_format("mark", "yyyy-MM-dd HH:mm:ss"), "o_orderkey": F.col("mark").cast("string"), "o_orderpriority": F.col("mark")}
    kinds = {"o_orderdate": marks.DATETIME, "o_orderkey": marks.NUMERIC, "o_orderpriority": marks.STRING}
    one, two, three = (_override(spark, d, c, k, None).select("o_orderkey", text[c].alias("mark")) for c, k in kinds.items())
    return one.union(two).union(three)


@query("backfill_extract", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def backfill_extract(spark, d):
    return landing.extract(Tables(spark, d).orders, ["o_orderkey", "o_orderdate"], "o_orderdate", "2000-01-01 00:00:00", inclusive=True)


@query("schema_evolve_additive", "SELECT p_partkey, p_name, p_size, CAST(NULL AS INTEGER) AS p_weight, CAST(NULL AS VARCHAR) AS p_note FROM part")
def schema_evolve_additive(spark, d):
    p = Tables(spark, d).part.select("p_partkey", "p_name", "p_size")
    return shape.evolve(p, {"P_NAME": "string", "p_weight": "int", "p_note": "string"})


@query("write_replace", "SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, CAST(NULL AS VARCHAR) AS p_note FROM part WHERE p_size > 10")
def write_replace(spark, d):
    t = Tables(spark, d)
    target = t.part.select("p_partkey", "p_name", F.col("p_size").cast("long"), F.lit(None).cast("string").alias("p_note"))
    root = _scratch(spark, "snapshots")
    landing.write_snapshot(target, root)
    landing.write_snapshot(merge.replace(landing.read_snapshot(spark, root), t.part.where("p_size > 10").select("p_size", "p_partkey", "p_name")), root)
    return landing.read_snapshot(spark, root)


@query("write_append_idempotent", "SELECT event_id, user_id, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'r1' ELSE 'r2' END AS bronze_entity_run_id FROM events")
def write_append_idempotent(spark, d):
    e = Tables(spark, d).events.select("event_id", "user_id", F.when(F.col("ts") < "2024-01-15", "r1").otherwise("r2").alias("bronze_entity_run_id"))
    batch = e.where("bronze_entity_run_id = 'r2'")
    once = merge.append(e.where("bronze_entity_run_id = 'r1'"), batch, "r2")
    return merge.append(once, batch, "r2")


# ---- shape -------------------------------------------------------------------


@query("project_cast", "SELECT o_orderkey AS order_key, CAST(o_totalprice AS DECIMAL(18,2)) AS price, CAST(o_orderdate AS DATE) AS order_date, upper(o_orderpriority) AS priority, CAST(NULL AS VARCHAR) AS gone, TRY_CAST(o_orderstatus AS DECIMAL(9,0)) AS no_number FROM orders")
def project_cast(spark, d):
    o = Tables(spark, d).orders
    raw = o.select(*[F.col(c).cast("string").alias(c.upper()) for c in o.columns])
    cols = [ColumnSpec("o_orderkey", "order_key", "bigint"), ColumnSpec("o_totalprice", "price", MONEY), ColumnSpec("o_orderdate", "order_date", "date"), ColumnSpec("o_orderpriority", "priority", "string", mapping="upper(o_orderpriority)"), ColumnSpec("nowhere", "gone", "string"), ColumnSpec("o_orderstatus", "no_number", "decimal(9,0)")]
    return shape.project(raw, cols)


@query("technical_columns", f"SELECT p_partkey, 'run-1' AS bronze_run_id, 'run-1-E7' AS bronze_entity_run_id, '{NOW}' AS created, 'erp' AS bronze_source_system, 'part' AS bronze_source_table, 'ACTIVE' AS bronze_record_status FROM part")
def technical_columns(spark, d):
    p = shape.with_technical(Tables(spark, d).part, "run-1", "run-1-E7", NOW, "erp", "part")
    return p.select("p_partkey", "bronze_run_id", "bronze_entity_run_id", text_time("bronze_created_datetime").alias("created"), "bronze_source_system", "bronze_source_table", "bronze_record_status")


@query("active_filter", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY')")
def active_filter(spark, d):
    c = Tables(spark, d).customer.withColumn("is_active", F.col("c_acctbal") >= 0)
    return spec.active_entities(c, groups=["BUILDING", "MACHINERY"], entity="c_custkey", group="c_mktsegment").select("c_custkey", "c_name")


@query("rls_filter", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1 OR (n_regionkey = 2 AND c_mktsegment = 'BUILDING')")
def rls_filter(spark, d):
    t = Tables(spark, d)
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    region = F.col("r_regionkey")
    access = t.region.select(F.when(region == 3, "bob").otherwise("ann").alias("user_name"), (region > 0).alias("is_active"), region.alias("region_key"), F.when(region == 2, "BUILDING").alias("segment"))
    access = access.where("region_key in (0, 1, 2, 3)")
    return checks.visible_rows(rows, access, "ann", {"n_regionkey": "region_key", "c_mktsegment": "segment"}).select("c_custkey", "c_nationkey", "c_mktsegment")


@query("union_by_name", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier")
def union_by_name(spark, d):
    t = Tables(spark, d)
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")), allowMissingColumns=True)


@query("json_parameters", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_parameters(spark, d):
    return Tables(spark, d).events.select("event_id", F.from_json("props", "map<string,string>")["k"].cast("long").alias("k"))


@query("control_entity_lookup", "SELECT s_suppkey, s_name, n_name, r_name, coalesce(c1.p_name, 'none') AS first_setting, coalesce(c2.p_brand, 'none') AS second_setting FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN part c1 ON c1.p_partkey = s_suppkey AND c1.p_size > 25 LEFT JOIN part c2 ON c2.p_partkey = s_suppkey * 2 WHERE n_regionkey <> 0")
def control_entity_lookup(spark, d):
    t = Tables(spark, d)
    e = t.supplier.join(t.nation.where("n_regionkey <> 0"), F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    one = t.part.where("p_size > 25").select(F.col("p_partkey").alias("k1"), F.col("p_name").alias("v1"))
    two = t.part.select(F.col("p_partkey").alias("k2"), F.col("p_brand").alias("v2"))
    e = e.join(one, F.col("s_suppkey") == F.col("k1"), "left").join(two, F.col("s_suppkey") * 2 == F.col("k2"), "left")
    return e.select("s_suppkey", "s_name", "n_name", "r_name", F.coalesce("v1", F.lit("none")).alias("first_setting"), F.coalesce("v2", F.lit("none")).alias("second_setting"))


@query("ordered_list_agg", "SELECT p_brand, string_agg(p_name, ', ' ORDER BY p_size, p_partkey) AS listed FROM part GROUP BY p_brand")
def ordered_list_agg(spark, d):
    return spec.ordered_list(Tables(spark, d).part, ["p_brand"], ["p_size", "p_partkey"], "p_name")


@query("ordered_list_pieces", "SELECT p_brand, CAST(piece AS BIGINT) AS piece, string_agg(p_name, ', ' ORDER BY p_size, p_partkey) AS listed FROM (SELECT *, (row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) - 1) // 20 AS piece FROM part) GROUP BY ALL")
def ordered_list_pieces(spark, d):
    """Lists of any length, in pieces of 20."""
    return spec.ordered_pieces(Tables(spark, d).part, ["p_brand"], ["p_size", "p_partkey"], "p_name", most=20)


@query("work_items", "SELECT o_orderkey AS entity_id, c_nationkey AS priority FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0 AND o_orderstatus = 'P'")
def work_items(spark, d):
    t = Tables(spark, d)
    active = t.orders.join(t.customer.where("c_acctbal > 0"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("entity_id"), F.col("c_nationkey").alias("priority"))
    return spec.work_items(t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("entity_id")), active, "entity_id", "priority")


@query("assemble_entities", "SELECT n_nationkey AS entity_id, n_name, coalesce(c.columns, '') AS columns, coalesce(s.rules, '') AS rules FROM nation LEFT JOIN (SELECT c_nationkey, string_agg(c_name, '|' ORDER BY c_custkey) AS columns FROM customer GROUP BY 1) c ON c_nationkey = n_nationkey LEFT JOIN (SELECT s_nationkey, string_agg(s_name, '|' ORDER BY s_name) AS rules FROM supplier GROUP BY 1) s ON s_nationkey = n_nationkey")
def assemble_entities(spark, d):
    t = Tables(spark, d)
    cols = t.customer.select(F.col("c_nationkey").alias("entity_id"), F.col("c_custkey").alias("ordinal"), F.col("c_name").alias("name"))
    own = t.supplier.select(F.col("s_nationkey").alias("entity_id"), F.col("s_name").alias("rule_name"))
    out = spec.assemble(t.nation.withColumnRenamed("n_nationkey", "entity_id"), cols, own)
    return out.select("entity_id", "n_name", F.coalesce(F.array_join("columns.name", "|"), F.lit("")).alias("columns"), F.coalesce(F.array_join("rules", "|"), F.lit("")).alias("rules"))


# ---- dedup and windows ---------------------------------------------------------

_LINE = "l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, l_shipdate"


def _lines(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast(MONEY), F.col("l_extendedprice").cast(MONEY), "l_shipdate")


@query("dedup_latest_per_key", f"SELECT l_orderkey, l_linenumber, {_LINE} FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1")
def dedup_latest_per_key(spark, d):
    return dedup.latest_per_key(_lines(Tables(spark, d)), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query("dedup_exact", "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def dedup_exact(spark, d):
    return dedup.exact(Tables(spark, d).lineitem.select("l_orderkey", "l_returnflag", "l_linestatus"))


@query("dedup_rejected_count", "SELECT CAST(sum(n - 1) AS BIGINT) AS surplus_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY nullif(l_orderkey, 1), l_linenumber)")
def dedup_rejected_count(spark, d):
    return dedup.surplus(Tables(spark, d).lineitem.withColumn("l_orderkey", F.expr("nullif(l_orderkey, 1)")), ["l_orderkey", "l_linenumber"])


_COLLAPSED = "SELECT user_id, ts, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) WHERE b IS NULL OR b <> event_type"


@query("collapse_consecutive", _COLLAPSED)
def collapse_consecutive(spark, d):
    return history.collapse(Tables(spark, d).events, ["user_id"], ["ts", "event_id"], "event_type").select("user_id", "ts", "event_type")


@query("history_build", f"SELECT user_id, ts AS valid_from, event_type, lead(ts) OVER w AS valid_to, lead(ts) OVER w IS NULL AS is_current FROM ({_COLLAPSED}) WINDOW w AS (PARTITION BY user_id ORDER BY ts)")
def history_build(spark, d):
    rows = history.collapse(Tables(spark, d).events, ["user_id"], ["ts", "event_id"], "event_type").select("user_id", F.col("ts").alias("valid_from"), "event_type")
    return history.intervals(rows, ["user_id"], ["valid_from"], "valid_from", "valid_to", "is_current")


@query("topn_per_group", "SELECT event_type, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) <= 5")
def topn_per_group(spark, d):
    return dedup.top_per_key(Tables(spark, d).events, ["event_type"], [F.col("ts").desc()], 5).select("event_type", "event_id", "ts")


# ---- hashing -------------------------------------------------------------------


def _orders(t):
    return t.orders.select("o_orderkey", "o_orderdate", F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"), F.col("o_totalprice").cast(MONEY), "o_orderpriority")


_ORDERS = "SELECT o_orderkey, o_orderdate, nullif(o_orderstatus, 'P') AS o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderpriority FROM orders"
_HASH = "sha256(concat_ws(chr(31), coalesce(o_orderstatus, '\\N'), CAST(o_totalprice AS VARCHAR), o_orderpriority))"


@query("canonical_values", f"SELECT o_orderkey, coalesce(o_orderstatus, '\\N') AS status, CAST(o_totalprice AS VARCHAR) AS price, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS order_time, strftime(o_orderdate, '%Y-%m-%d') AS order_date, CASE WHEN o_totalprice > 100000 THEN 'true' ELSE 'false' END AS large, lower(hex(o_orderpriority)) AS raw FROM ({_ORDERS})")
def canonical_values(spark, d):
    o = _orders(Tables(spark, d)).withColumns({"day": F.to_date("o_orderdate"), "big": F.col("o_totalprice") > 100000, "bytes": F.col("o_orderpriority").cast("binary")})
    names = {"o_orderstatus": "status", "o_totalprice": "price", "o_orderdate": "order_time", "day": "order_date", "big": "large", "bytes": "raw"}
    return o.select("o_orderkey", *[canonical(o, c).alias(n) for c, n in names.items()])


@query("record_hash", f"SELECT o_orderkey, {_HASH} AS record_hash FROM ({_ORDERS})")
def record_hash_query(spark, d):
    o = _orders(Tables(spark, d))
    return o.select("o_orderkey", record_hash(o, ["o_orderstatus", "o_totalprice", "o_orderpriority"]).alias("record_hash"))


def _loaded(rows, run, now):
    rows = rows.withColumn("bronze_record_hash", record_hash(rows, ["o_orderstatus", "o_totalprice", "o_orderpriority"]))
    return shape.with_technical(rows, run, f"{run}-E1", now, "erp", "orders")


def _split(t):
    """A target and a batch of orders: some rows equal, some changed, some new, some missing."""
    o = _orders(t)
    m = F.col("o_orderkey") % 10
    target = _loaded(o.where(m < 8), "run-1", "2024-01-01 00:00:00")
    batch = o.where(m >= 5).withColumn("o_totalprice", F.when(m == 6, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).cast(MONEY))
    return target, _loaded(batch, "run-2", NOW)


_SPLIT = f"WITH t AS (SELECT *, {_HASH} AS h FROM ({_ORDERS}) WHERE o_orderkey % 10 < 8), s AS (SELECT *, {_HASH} AS h FROM (SELECT * REPLACE (CAST(CASE WHEN o_orderkey % 10 = 6 THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(18,2)) AS o_totalprice) FROM ({_ORDERS}) WHERE o_orderkey % 10 >= 5))"


@query("change_detect", f"{_SPLIT} SELECT t.o_orderkey, t.h <> s.h AS is_changed FROM t JOIN s ON t.o_orderkey = s.o_orderkey")
def change_detect(spark, d):
    target, batch = _split(Tables(spark, d))
    joined = target.alias("t").join(batch.alias("s"), F.col("t.o_orderkey") == F.col("s.o_orderkey"))
    return joined.select(F.col("t.o_orderkey"), merge.changed().alias("is_changed"))


@query("change_classify", f"{_SPLIT} SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, CASE WHEN t.o_orderkey IS NULL THEN 'new' WHEN s.o_orderkey IS NULL THEN 'missing' WHEN t.h = s.h THEN 'unchanged' ELSE 'changed' END AS change FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey")
def change_classify(spark, d):
    target, batch = _split(Tables(spark, d))
    return merge.classify(target, batch, ["o_orderkey"])


_MERGED = f"""{_SPLIT}, m AS (SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
CASE WHEN t.o_orderkey IS NULL THEN 'INSERT' WHEN s.o_orderkey IS NULL THEN GONE WHEN t.h <> s.h THEN 'UPDATE' ELSE 'KEEP' END AS action,
t.o_totalprice AS tp, s.o_totalprice AS sp, t.h AS th, s.h AS sh FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey)
SELECT o_orderkey, action AS "_action", CASE WHEN action IN ('INSERT', 'UPDATE') THEN sp ELSE tp END AS o_totalprice,
CASE WHEN action IN ('INSERT', 'UPDATE') THEN sh ELSE th END AS bronze_record_hash,
CASE WHEN action = 'DELETE' THEN 'DELETED' ELSE 'ACTIVE' END AS bronze_record_status,
CASE WHEN action = 'INSERT' THEN '{NOW}' ELSE '2024-01-01 00:00:00' END AS created,
CASE WHEN action = 'KEEP' THEN '2024-01-01 00:00:00' ELSE '{NOW}' END AS updated,
CASE WHEN action = 'KEEP' THEN 'run-1' ELSE 'run-2' END AS bronze_run_id FROM m"""


def _shown(merged):
    return merged.select("o_orderkey", "_action", "o_totalprice", "bronze_record_hash", "bronze_record_status", text_time("bronze_created_datetime").alias("created"), text_time("bronze_updated_datetime").alias("updated"), "bronze_run_id")


@query("merge_upsert", _MERGED.replace("GONE", "'KEEP'"))
def merge_upsert(spark, d):
    return _shown(merge.merge(*_split(Tables(spark, d)), ["o_orderkey"]))


@query("merge_soft_delete", _MERGED.replace("GONE", "'DELETE'"))
def merge_soft_delete(spark, d):
    return _shown(merge.merge(*_split(Tables(spark, d)), ["o_orderkey"], full_load=True, soft_delete=True))


@query("merge_metrics", f"{_SPLIT} SELECT count(*) FILTER (t.o_orderkey IS NULL) AS inserted, count(*) FILTER (t.h <> s.h) AS updated, count(*) FILTER (s.o_orderkey IS NULL) AS deleted FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey")
def merge_metrics(spark, d):
    return merge.metrics(merge.merge(*_split(Tables(spark, d)), ["o_orderkey"], full_load=True, soft_delete=True))


@query("merge_revive", "SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'UPDATE' ELSE 'KEEP' END AS \"_action\", 'ACTIVE' AS bronze_record_status FROM supplier")
def merge_revive(spark, d):
    s = Tables(spark, d).supplier.select("s_suppkey", "s_name")
    s = s.withColumn("bronze_record_hash", record_hash(s, ["s_name"]))
    target = shape.with_technical(s, "run-1", "run-1-E2", "2024-01-01 00:00:00", "erp", "supplier").withColumn("bronze_record_status", F.when(F.col("s_suppkey") % 4 == 0, shape.DELETED).otherwise(shape.ACTIVE))
    batch = shape.with_technical(s, "run-2", "run-2-E2", NOW, "erp", "supplier")
    return merge.merge(target, batch, ["s_suppkey"]).select("s_suppkey", "_action", "bronze_record_status")


# ---- history -------------------------------------------------------------------


def _versions(t):
    """A versioned target of events before the 15th, and a batch from the 14th on."""
    e = t.events.select("user_id", "event_type", F.col("ts").alias("bronze_valid_from"))
    e = e.withColumn("bronze_record_hash", record_hash(e, ["event_type"]))
    old = history.collapse(e.where("bronze_valid_from < timestamp_ntz'2024-01-15'"), ["user_id"], ["bronze_valid_from"])
    return history.intervals(old, ["user_id"], ["bronze_valid_from"]), e.where("bronze_valid_from >= timestamp_ntz'2024-01-14'")


_H = """WITH e AS (SELECT user_id, event_type, ts, event_id FROM events),
c AS (SELECT * FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS b FROM e WHERE ts < TIMESTAMP '2024-01-15') WHERE b IS NULL OR b <> event_type),
t AS (SELECT user_id, event_type, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM c),
cur AS (SELECT * FROM t WHERE nxt IS NULL),
cand AS (SELECT e.user_id, e.event_type, e.ts, cur.event_type AS seed FROM e LEFT JOIN cur ON e.user_id = cur.user_id WHERE e.ts >= TIMESTAMP '2024-01-14' AND (cur.ts IS NULL OR e.ts > cur.ts OR (e.ts = cur.ts AND e.event_type <> cur.event_type))),
v AS (SELECT user_id, event_type, ts FROM (SELECT *, coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY ts), seed) AS b FROM cand) WHERE b IS NULL OR b <> event_type),
n AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM v),
f AS (SELECT user_id, min(ts) AS first FROM v GROUP BY user_id)
"""


@query("history_candidates", _H + "SELECT user_id, event_type, ts AS bronze_valid_from FROM cand")
def history_candidates(spark, d):
    target, batch = _versions(Tables(spark, d))
    return history.candidates(batch, target, ["user_id"]).select("user_id", "event_type", "bronze_valid_from")


@query("history_apply", _H + "SELECT t.user_id, event_type, t.ts AS bronze_valid_from, coalesce(nxt, first) AS bronze_valid_to, nxt IS NULL AND first IS NULL AS bronze_is_current FROM t LEFT JOIN f ON t.user_id = f.user_id UNION ALL SELECT user_id, event_type, ts, nxt, nxt IS NULL FROM n")
def history_apply(spark, d):
    target, batch = _versions(Tables(spark, d))
    return history.apply(target, batch, ["user_id"]).select("user_id", "event_type", "bronze_valid_from", "bronze_valid_to", "bronze_is_current")


# ---- marks ---------------------------------------------------------------------


@query("watermark_batch_max", "SELECT o_orderstatus, max(o_orderdate) AS batch_mark FROM orders GROUP BY o_orderstatus")
def watermark_batch_max(spark, d):
    return state.batch_max(Tables(spark, d).orders, "o_orderdate", ["o_orderstatus"])


@query("watermark_resolve", "SELECT user_id, greatest(max(ts) FILTER (ts < TIMESTAMP '2024-01-10'), max(ts) FILTER (event_type = 'error')) AS mark FROM events GROUP BY user_id")
def watermark_resolve(spark, d):
    g = Tables(spark, d).events.groupBy("user_id").agg(F.max(F.when(F.col("ts") < "2024-01-10", F.col("ts"))).alias("before"), F.max(F.when(F.col("event_type") == "error", F.col("ts"))).alias("batch"))
    return g.select("user_id", marks.advanced(F.col("before"), F.col("batch")).alias("mark"))


@query("watermark_format", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time_mark, CAST(event_id * 10 AS VARCHAR) AS number_mark, ts AS parsed FROM events")
def watermark_format(spark, d):
    e = Tables(spark, d).events
    text = marks.mark_text(F.col("ts"), marks.DATETIME)
    return e.select("event_id", text.alias("time_mark"), marks.mark_text(F.col("event_id") * 10, marks.NUMERIC).alias("number_mark"), marks.parsed_mark(F.replace(text, F.lit(" "), F.lit("T")), marks.DATETIME).alias("parsed"))


@query("watermark_commit", "WITH s AS (SELECT user_id AS entity, CAST(max(event_id) AS VARCHAR) AS mark FROM events WHERE event_type <> 'purchase' GROUP BY 1), p AS (SELECT user_id AS entity, CAST(max(event_id) FILTER (event_type <> 'purchase') AS VARCHAR) AS expected, CASE WHEN user_id % 3 <> 0 THEN CAST(max(event_id) + user_id % 2 AS VARCHAR) END AS proposed FROM events WHERE event_type <> 'error' GROUP BY user_id), j AS (SELECT coalesce(p.entity, s.entity) AS entity, p.entity AS pe, s.entity AS se, expected, proposed, mark FROM p FULL JOIN s ON p.entity = s.entity), o AS (SELECT *, CASE WHEN pe IS NULL THEN 'untouched' WHEN se IS NULL THEN 'inserted' WHEN proposed IS NULL OR proposed = mark THEN 'noop' WHEN mark = expected THEN 'committed' ELSE 'conflict' END AS outcome FROM j) SELECT entity, CASE WHEN outcome IN ('inserted', 'committed') THEN proposed ELSE mark END AS mark, outcome FROM o")
def watermark_commit(spark, d):
    """Marks of users by their events but purchases; proposals by all but errors, which saw a later or an older mark or none."""
    e = Tables(spark, d).events
    bought = F.col("event_type") == "purchase"
    s = e.where(~bought).groupBy(F.col("user_id").alias("entity")).agg(F.max("event_id").cast("string").alias("mark"))
    p = e.where("event_type <> 'error'").groupBy(F.col("user_id").alias("entity")).agg(F.max("event_id").alias("m"), F.max(F.when(~bought, F.col("event_id"))).alias("old"))
    p = p.select("entity", F.col("old").cast("string").alias("expected"), F.when(F.col("entity") % 3 != 0, (F.col("m") + F.col("entity") % 2).cast("string")).alias("proposed"))
    return state.commit(s, p)
