"""Registered queries of whole loads by strategy, staging, rule planning and what goes with them."""

from __future__ import annotations

from dataclasses import asdict, replace

from pyspark.sql import functions as F

from siltbed.functions.canonical import quoted
from siltbed.operators import audit, dedup, dimensional, rules, shape
from siltbed.operators.rules import Rule
from siltbed.operators.shape import ColumnSpec
from siltbed.plans import job, spec
from siltbed.plans.more_queries import LINE_SPEC
from siltbed.plans.queries import MONEY, NOW, Tables, _scratch, query
from siltbed.sources import landing

# ---- staging, schemas, names -------------------------------------------------------


@query("staging_overwrite", "SELECT o_orderkey, o_orderstatus, 'run-2' AS _staging_run_id FROM orders WHERE o_totalprice > 100000")
def staging_overwrite(spark, d):
    """Two runs stage one after the other; the second's rows are what is there."""
    path, o = _scratch(spark, "staging"), Tables(spark, d).orders
    landing.stage(o.select("o_orderkey"), path, "run-1")
    landing.stage(o.where("o_totalprice > 100000").select("o_orderkey", "o_orderstatus"), path, "run-2")
    return spark.read.parquet(path)


@query("staging_truncate", "SELECT 'l_orderkey,l_returnflag,_staging_run_id' AS columns, count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM lineitem")
def staging_truncate(spark, d):
    path = _scratch(spark, "staging")
    landing.stage(Tables(spark, d).lineitem.select("l_orderkey", "l_returnflag"), path, "run-1")
    before = spark.read.parquet(path).agg(F.count("*").alias("rows_before"))
    before.write.parquet(f"{path}-before")
    landing.truncate(spark, path)
    empty = spark.read.parquet(path)
    after = empty.agg(F.lit(",".join(empty.columns)).alias("columns"), F.count("*").alias("n"))
    both = after.select("columns", F.lit(0).cast("long").alias("a"), "n").union(spark.read.parquet(f"{path}-before").select(F.lit(None), "rows_before", F.lit(0).cast("long")))
    return both.agg(F.max("columns").alias("columns"), F.max("a").alias("rows_before"), F.max("n").alias("rows_after"))


@query("schema_derivation", "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity, l_shipdate, CAST(NULL AS VARCHAR) AS bronze_record_hash, CAST(NULL AS TIMESTAMP) AS bronze_valid_from, CAST(NULL AS BOOLEAN) AS bronze_is_current FROM lineitem")
def schema_derivation(spark, d):
    """An empty versioned table of the specification's schema takes the typed rows."""
    line = Tables(spark, d).lineitem
    empty = spark.createDataFrame([], shape.table_schema(LINE_SPEC.columns, versioned=True))
    out = empty.unionByName(shape.project(line, LINE_SPEC.columns), allowMissingColumns=True)
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "bronze_record_hash", F.col("bronze_valid_from").cast("timestamp_ntz").alias("bronze_valid_from"), "bronze_is_current")


@query("identifier_quoting", 'SELECT p_partkey, p_name AS "p`name", p_size AS "p.size ""x""" FROM part')
def identifier_quoting(spark, d):
    odd = Tables(spark, d).part.select("p_partkey", F.col("p_name").alias("p`name"), F.col("p_size").alias('p.size "x"'))
    return odd.select(*[F.col(quoted(c)) for c in odd.columns])


@query("dedup_mode", "SELECT 'latest' AS mode, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) UNION ALL SELECT m, count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate, l_partkey FROM lineitem), (VALUES ('versions'), ('no key')) t(m) GROUP BY m")
def dedup_mode(spark, d):
    line = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")
    keys = ["l_orderkey", "l_linenumber"]
    modes = {"latest": (keys, False), "versions": (keys, True), "no key": ([], False)}
    out = [dedup.deduplicate(line, k, "l_shipdate", v).agg(F.lit(m).alias("mode"), F.count("*").alias("n")) for m, (k, v) in modes.items()]
    return out[0].union(out[1]).union(out[2])


@query("ingestion_sequence", "SELECT event_type, user_id, event_id, CAST(ts AS DATE) AS day FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY CAST(ts AS DATE) DESC, event_id DESC) = 1")
def ingestion_sequence(spark, d):
    """Rows of one key and day are told apart by the order in which they came."""
    e = Tables(spark, d).events.select("event_type", "user_id", "event_id", F.to_date("ts").alias("day"))
    return dedup.deduplicate(e, ["event_type", "user_id"], "day", False, ["event_id"])


# ---- rules -----------------------------------------------------------------------


@query("rule_plan", """SELECT * FROM (SELECT 'builtin_primary_key_null' AS rule_name, 'PASSED' AS status, CAST(0 AS BIGINT) AS failed_row_count
UNION ALL SELECT 'builtin_column_missing', 'PASSED', 0 UNION ALL SELECT 'builtin_data_type_mismatch', CASE WHEN n > 0 THEN 'FAILED' ELSE 'PASSED' END, n FROM (SELECT count(*) FILTER (o_orderstatus <> '') AS n FROM orders)
UNION ALL SELECT 'own_duplicates', CASE WHEN n > 0 THEN 'WARNING' ELSE 'PASSED' END, n FROM (SELECT count(*) - count(DISTINCT o_custkey) AS n FROM orders)
UNION ALL SELECT 'price_type', 'PASSED', 0)""")
def rule_plan(spark, d):
    """Built-in rules but the one that a rule replaces; a type rule for one column replaces none."""
    cols = [ColumnSpec("o_custkey", "o_custkey", "bigint", key=True), ColumnSpec("o_totalprice", "o_totalprice", MONEY), ColumnSpec("o_orderstatus", "o_orderstatus", "int")]
    own = [Rule("own_duplicates", rules.DUPLICATE, action=rules.WARN), Rule("price_type", rules.TYPE, "o_totalprice")]
    raw = Tables(spark, d).orders
    found = rules.report(shape.project(raw, cols), rules.effective_rules(own, True), ["o_custkey"], cols, raw)
    return found.select("rule_name", "status", "failed_row_count")


@query("rule_gate", "WITH n AS (SELECT count(*) FILTER (l_quantity > 45) AS n FROM lineitem) SELECT a AS action, a = 'FAIL' AND n > 0 AS is_blocked FROM n, (VALUES ('FAIL'), ('WARN'), ('IGNORE')) t(a)")
def rule_gate(spark, d):
    line = Tables(spark, d).lineitem
    found = rules.report(line, [Rule(a, rules.CUSTOM, expression="l_quantity <= 45", action=a) for a in (rules.FAIL, rules.WARN, rules.IGNORE)], [])
    return found.select(F.col("rule_name").alias("action"), rules.is_blocking(F.col("status")).alias("is_blocked"))


@query("rule_unique_lookup", "SELECT 'brand and size' AS rule_name, 'WARNING' AS status, (SELECT count(*) FROM part) - (SELECT count(*) FROM (SELECT DISTINCT p_brand, p_size FROM part)) AS failed_row_count UNION ALL SELECT 'supplier', CASE WHEN n > 0 THEN 'FAILED' ELSE 'PASSED' END, n FROM (SELECT count(*) AS n FROM part WHERE p_partkey NOT IN (SELECT s_suppkey FROM supplier))")
def rule_unique_lookup(spark, d):
    t = Tables(spark, d)
    own = [Rule("brand and size", rules.UNIQUE, columns=("p_brand", "p_size"), action=rules.WARN), Rule("supplier", rules.LOOKUP, "p_partkey", reference="supplier", columns=("s_suppkey",))]
    return rules.report(t.part, own, [], references={"supplier": t.supplier}).select("rule_name", "status", "failed_row_count")


_ENTITIES = "SELECT c_custkey AS entity_id, CASE c_mktsegment WHEN 'BUILDING' THEN 'FULL' WHEN 'MACHINERY' THEN 'OTHER' ELSE 'INCREMENTAL' END AS load_type, c_nationkey < 5 AS has_history, c_acctbal > 0 AS is_merged FROM customer"


@query("control_problems", f"""WITH e0 AS ({_ENTITIES}), e AS (SELECT *, 1 + CAST(entity_id % 10 = 0 AS INTEGER) AS n FROM e0),
c AS (SELECT o_custkey + 20 AS entity_id, o_orderpriority AS target, count(*) AS n, bool_or(o_orderstatus = 'O') AS is_key, bool_or(o_totalprice > 400000) AS is_mark FROM orders GROUP BY ALL),
g AS (SELECT entity_id, bool_or(n > 1) AS twice, bool_or(is_key) AS is_key, bool_or(is_mark) AS is_mark FROM c GROUP BY 1),
j AS (SELECT coalesce(e.entity_id, g.entity_id) AS entity_id, e.entity_id IS NOT NULL AS there, g.entity_id IS NOT NULL AS any_, n, load_type, has_history, is_merged, coalesce(twice, false) AS twice, coalesce(is_key, false) AS is_key, coalesce(is_mark, false) AS is_mark FROM e FULL JOIN g ON e.entity_id = g.entity_id)
SELECT entity_id, 'columns of no entity' AS problem FROM j WHERE NOT there UNION ALL SELECT entity_id, 'no columns' FROM j WHERE there AND NOT any_ UNION ALL SELECT entity_id, 'the entity occurs twice' FROM j WHERE n > 1
UNION ALL SELECT entity_id, 'a target column occurs twice' FROM j WHERE twice UNION ALL SELECT entity_id, 'no key' FROM j WHERE there AND (has_history OR is_merged) AND NOT is_key
UNION ALL SELECT entity_id, 'no mark' FROM j WHERE load_type = 'INCREMENTAL' AND NOT has_history AND NOT is_mark UNION ALL SELECT entity_id, 'unknown load type' FROM j WHERE load_type = 'OTHER'""")
def control_problems(spark, d):
    """Checks across a control set of the size of customer and orders."""
    t = Tables(spark, d)
    load = F.when(F.col("c_mktsegment") == "BUILDING", "FULL").when(F.col("c_mktsegment") == "MACHINERY", "OTHER").otherwise("INCREMENTAL")
    e = t.customer.select(F.col("c_custkey").alias("entity_id"), load.alias("load_type"), (F.col("c_nationkey") < 5).alias("has_history"), (F.col("c_acctbal") > 0).alias("is_merged"))
    c = t.orders.select((F.col("o_custkey") + 20).alias("entity_id"), F.col("o_orderpriority").alias("target"), (F.col("o_orderstatus") == "O").alias("is_key"), (F.col("o_totalprice") > 400000).alias("is_mark"))
    return spec.control_problems(e.union(e.where("entity_id % 10 = 0")), c)


# ---- whole loads by strategy --------------------------------------------------------

ORDER_SPEC = spec.EntitySpec(
    7, "erp", "orders",
    [ColumnSpec("o_orderkey", "o_orderkey", "bigint", key=True), ColumnSpec("o_orderstatus", "o_orderstatus", "string"), ColumnSpec("o_totalprice", "o_totalprice", MONEY), ColumnSpec("o_orderdate", "o_orderdate", "timestamp_ntz", mark=True, hashed=False)],
    mark_type="DATETIME",
    rules=[Rule("price", rules.CUSTOM, expression="o_totalprice > 0"), Rule("large", rules.CUSTOM, expression="o_totalprice < 400000", action=rules.WARN, stage=rules.POST), Rule("one row a key", rules.UNIQUE, columns=("o_orderkey",), action=rules.WARN, stage=rules.POST)],
)
#: Both batches in SQL: n, the rows, and what is loaded of them.
_B = "WITH o AS (SELECT o_orderkey, o_orderkey % 10 AS m, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate FROM orders), one AS (SELECT * FROM o WHERE m < 8), two AS (SELECT * REPLACE (CAST(CASE WHEN m = 6 THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(18,2)) AS o_totalprice, o_orderdate + INTERVAL 1 DAY AS o_orderdate) FROM o WHERE m >= 5) "


def _loads(spark, d, entity):
    """Two batches of orders, one after the other: some rows equal, some changed, some new, some missing."""
    root, o = _scratch(spark, "loads"), Tables(spark, d).orders
    m = F.col("o_orderkey") % 10
    price = F.col("o_totalprice").cast(MONEY)
    raw = lambda df: df.select(*[F.col(c).cast("string").alias(c) for c in ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")])
    one = raw(o.where(m < 8).withColumn("o_totalprice", price))
    two = raw(o.where(m >= 5).withColumns({"o_totalprice": F.when(m == 6, price + 1).otherwise(price).cast(MONEY), "o_orderdate": F.col("o_orderdate") + F.make_dt_interval(F.lit(1))}))
    marks = spark.createDataFrame([(8, "x")], "entity long, mark string")
    first = job.load(entity, one, root, marks, "run-1", "run-1-E7", "2024-01-01 00:00:00")
    return job.load(entity, two, root, first.marks, "run-2", "run-2-E7", NOW)


_SHOWN = ["o_orderkey", "o_orderstatus", "o_totalprice", "bronze_record_status", "bronze_run_id"]
_MERGED = "SELECT coalesce(two.o_orderkey, one.o_orderkey) AS o_orderkey, coalesce(two.o_orderstatus, one.o_orderstatus) AS o_orderstatus, coalesce(two.o_totalprice, one.o_totalprice) AS o_totalprice, STATUS AS bronze_record_status, CASE WHEN one.o_orderkey IS NULL OR two.m = 6 OR GONE THEN 'run-2' ELSE 'run-1' END AS bronze_run_id FROM one FULL JOIN two ON one.o_orderkey = two.o_orderkey"


@query("load_merge", _B + _MERGED.replace("STATUS", "'ACTIVE'").replace("GONE", "false"))
def load_merge(spark, d):
    return _loads(spark, d, ORDER_SPEC).target.select(*_SHOWN)


@query("load_full_soft_delete", _B + _MERGED.replace("STATUS", "CASE WHEN two.o_orderkey IS NULL THEN 'DELETED' ELSE 'ACTIVE' END").replace("GONE", "two.o_orderkey IS NULL"))
def load_full_soft_delete(spark, d):
    return _loads(spark, d, replace(ORDER_SPEC, full_load=True, soft_delete=True)).target.select(*_SHOWN)


@query("load_append", _B + "SELECT o_orderkey, o_orderstatus, o_totalprice, 'ACTIVE' AS bronze_record_status, 'run-1' AS bronze_run_id FROM one UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, 'ACTIVE', 'run-2' FROM two")
def load_append(spark, d):
    return _loads(spark, d, replace(ORDER_SPEC, merging=False)).target.select(*_SHOWN)


@query("load_replace", _B + "SELECT o_orderkey, o_orderstatus, o_totalprice, 'ACTIVE' AS bronze_record_status, 'run-2' AS bronze_run_id FROM two")
def load_replace(spark, d):
    return _loads(spark, d, replace(ORDER_SPEC, merging=False, full_load=True)).target.select(*_SHOWN)


@query("load_history", _B + "SELECT one.o_orderkey, one.o_totalprice, one.o_orderdate AS valid_from, CASE WHEN one.m = 6 THEN two.o_orderdate END AS valid_to, one.m <> 6 AS is_current FROM one LEFT JOIN two ON one.o_orderkey = two.o_orderkey UNION ALL SELECT o_orderkey, o_totalprice, o_orderdate, NULL, true FROM two WHERE m = 6 OR m >= 8")
def load_history(spark, d):
    out = _loads(spark, d, replace(ORDER_SPEC, history=True, rules=[])).target
    return out.select("o_orderkey", "o_totalprice", F.col("bronze_valid_from").cast("timestamp_ntz").alias("valid_from"), F.col("bronze_valid_to").cast("timestamp_ntz").alias("valid_to"), F.col("bronze_is_current").alias("is_current"))


@query("load_marks", _B + "SELECT CAST(7 AS BIGINT) AS entity, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS mark FROM (SELECT o_orderdate FROM one UNION ALL SELECT o_orderdate FROM two) UNION ALL SELECT 8, 'x'")
def load_marks(spark, d):
    """The marks after two loads: advanced, in canonical text, those of others as they were."""
    return _loads(spark, d, ORDER_SPEC).marks


@query("load_post_rules", _B + ", t AS (SELECT o_totalprice FROM one WHERE m < 5 UNION ALL SELECT o_totalprice FROM two) SELECT 'large' AS rule_name, 'CUSTOM' AS rule_type, CASE WHEN n > 0 THEN 'WARNING' ELSE 'PASSED' END AS status, n AS failed_row_count FROM (SELECT count(*) FILTER (o_totalprice >= 400000) AS n FROM t) UNION ALL SELECT 'one row a key', 'UNIQUE', 'PASSED', 0")
def load_post_rules(spark, d):
    """The report of the rules that look at the target after the write."""
    return _loads(spark, d, ORDER_SPEC).post


@query("load_metrics", _B + ", n AS (SELECT (SELECT count(*) FROM two) AS r, (SELECT count(*) FROM two WHERE m >= 8) AS i, (SELECT count(*) FROM two WHERE m = 6) AS u, (SELECT count(*) FROM two WHERE m IN (5, 7)) AS s, (SELECT count(*) FROM one WHERE m < 5) AS d) SELECT x.* FROM n, LATERAL (VALUES ('MERGE', r, 0, i, u, 0, s), ('SOFT DELETE', r, 0, i, u, d, s), ('NONE', r, 0, i, u + s, 0, 0), ('APPEND', r, 0, r, 0, 0, 0), ('REPLACE', r, 0, r, 0, 0, 0), ('HISTORY', r, 0, i + u, u, 0, s)) x(strategy, read, rejected, inserted, updated, deleted, unchanged)")
def load_metrics(spark, d):
    """What the second load did, by strategy, as its write observed it."""
    entities = {"MERGE": ORDER_SPEC, "SOFT DELETE": replace(ORDER_SPEC, full_load=True, soft_delete=True), "NONE": replace(ORDER_SPEC, change_detection="NONE"), "APPEND": replace(ORDER_SPEC, merging=False), "REPLACE": replace(ORDER_SPEC, merging=False, full_load=True), "HISTORY": replace(ORDER_SPEC, history=True, rules=[])}
    rows = [(name, *asdict(_loads(spark, d, entity).metrics).values()) for name, entity in entities.items()]
    return spark.createDataFrame(rows, "strategy string, read long, rejected long, inserted long, updated long, deleted long, unchanged long")


@query("load_change_detection_none", _B + _MERGED.replace("STATUS", "'ACTIVE'").replace("GONE", "two.o_orderkey IS NOT NULL"))
def load_change_detection_none(spark, d):
    """Without change detection every matched row is updated."""
    return _loads(spark, d, replace(ORDER_SPEC, change_detection="NONE")).target.select(*_SHOWN)


@query("load_staging_integrity", _B + "SELECT 'staging_integrity' AS rule_name, 'STAGING_INTEGRITY' AS rule_type, 'PASSED' AS status, CAST(0 AS BIGINT) AS failed_row_count UNION ALL SELECT 'staging_integrity', 'STAGING_INTEGRITY', 'FAILED', 1")
def load_staging_integrity(spark, d):
    """The staged rows of a load are those that were written; and they are one fewer than an extract said."""
    good = _loads(spark, d, replace(ORDER_SPEC, merging=False)).report
    o = Tables(spark, d).orders
    raw = o.select(*[F.col(c).cast("string").alias(c) for c in ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")])
    marks = spark.createDataFrame([], "entity long, mark string")
    bad = job.load(replace(ORDER_SPEC, merging=False), raw, _scratch(spark, "loads"), marks, "run-1", "run-1-E7", NOW, expected_rows=o.count() + 1).report
    return good.union(bad).where("rule_type = 'STAGING_INTEGRITY'")


@query("control_mask_problems", "SELECT o_custkey AS entity_id, 'column ' || o_orderpriority || ' names unknown mask rule ' || CAST(o_orderkey % 3000 AS VARCHAR) AS problem FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3000 NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)")
def control_mask_problems(spark, d):
    t = Tables(spark, d)
    columns = t.orders.select(F.col("o_custkey").alias("entity_id"), F.col("o_orderpriority").alias("target"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") % 3000).alias("mask_id"))
    return spec.mask_problems(columns, t.part.select(F.col("p_partkey").alias("mask_id"), (F.col("p_size") > 10).alias("is_active")))


@query("control_method_problems", "WITH e AS (SELECT c_custkey AS entity_id, CASE c_mktsegment WHEN 'BUILDING' THEN 'NONE' WHEN 'MACHINERY' THEN 'OTHER' ELSE 'HASH' END AS m, c_nationkey < 5 AS h FROM customer) SELECT entity_id, 'unknown change detection' AS problem FROM e WHERE m = 'OTHER' UNION ALL SELECT entity_id, 'HISTORY needs change detection HASH' FROM e WHERE h AND m <> 'HASH'")
def control_method_problems(spark, d):
    method = F.when(F.col("c_mktsegment") == "BUILDING", "NONE").when(F.col("c_mktsegment") == "MACHINERY", "OTHER").otherwise("HASH")
    e = Tables(spark, d).customer.select(F.col("c_custkey").alias("entity_id"), method.alias("change_detection"), (F.col("c_nationkey") < 5).alias("has_history"))
    return spec.method_problems(e)


# ---- audit and dimensions ---------------------------------------------------------


@query("audit_error_append", "SELECT event_id, user_id, event_type AS stage, CASE event_type WHEN 'error' THEN '08001:10054' WHEN 'signup' THEN '23000:547' END AS error_code, CASE event_type WHEN 'error' THEN '08001 (10054) ' WHEN 'signup' THEN '23000 (547) ' ELSE '' END || 'user ''<redacted>'' of <redacted-email>, number <redacted-number>' || CASE WHEN event_type = 'click' THEN ' timeout' ELSE ' refused' END AS error_message, event_type IN ('error', 'click') AS is_retryable, ts FROM events")
def audit_error_append(spark, d):
    e = Tables(spark, d).events
    code = F.when(F.col("event_type") == "error", "08001 (10054) ").when(F.col("event_type") == "signup", "23000 (547) ").otherwise("")
    message = F.concat(code, F.lit("user 'abc' of a@b.co, number "), F.col("event_id") + 10_000_000, F.when(F.col("event_type") == "click", " timeout").otherwise(" refused"))
    return audit.error_rows(e.withColumn("message", message), "event_id", "user_id", "event_type", "message", "ts")


@query("audit_file_processed", "SELECT user_id, strftime(ts, '%Y%m%d') AS path, arg_max(CASE WHEN event_id % 2 = 0 THEN 'p' || event_id ELSE 'r' || event_id END, ts) FILTER (event_type IN ('purchase', 'signup')) AS processed_run_id, max(ts) FILTER (event_type IN ('purchase', 'signup')) AS processed_datetime FROM events GROUP BY ALL")
def audit_file_processed(spark, d):
    status = F.when(F.col("event_type") == "purchase", "PROCESSED").when(F.col("event_type") == "signup", "REPLAYED").when(F.col("event_type") == "error", "FAILED").otherwise("CREATED")
    e = Tables(spark, d).events.select("user_id", F.date_format("ts", "yyyyMMdd").alias("path"), status.alias("status"), "ts", F.concat(F.lit("r"), "event_id").alias("run"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("p"), "event_id")).alias("by"))
    return audit.file_processing(e, ["user_id", "path"], "status", "ts", "run", "by")


@query("lookup_mandatory", "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT s_suppkey FROM supplier)")
def lookup_mandatory(spark, d):
    t = Tables(spark, d)
    return dimensional.lookup_misses(t.part, t.supplier, {"p_partkey": "s_suppkey"}).select("p_partkey", "p_name")


@query("dimension_overwrite", "SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'rich' ELSE c_name END AS name, c_mktsegment AS segment FROM customer WHERE c_nationkey < 20 OR c_acctbal > 5000")
def dimension_overwrite(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), "c_nationkey", "c_acctbal")
    batch = c.where("c_acctbal > 5000").withColumn("name", F.lit("rich"))
    return dimensional.overwritten(c.where("c_nationkey < 20").drop("c_nationkey", "c_acctbal"), batch, ["c_custkey"])


@query("fact_aggregates", "SELECT l_partkey, l_returnflag, count(*) AS n_facts, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS quantity, max(l_shipdate) AS last_ship FROM lineitem GROUP BY ALL")
def fact_aggregates(spark, d):
    return dimensional.fact_aggregate(Tables(spark, d).lineitem, ["l_partkey", "l_returnflag"], {"quantity": F.sum(F.col("l_quantity").cast(MONEY)), "last_ship": F.max("l_shipdate")})


@query("standard_pipeline", "SELECT p_brand AS brand, p_partkey AS part_key, CAST(p_size AS VARCHAR) AS size_text, coalesce(nullif(trim(replace(p_type, 'ECONOMY', '  ')), ''), 'none') AS kind, p_size * 2 AS twice FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey DESC) = 1")
def standard_pipeline(spark, d):
    """Rename, cast, trim, default, derive and one row a key."""
    p = Tables(spark, d).part.select("p_brand", "p_partkey", F.col("p_size").alias("twice_of"), F.col("p_size").alias("size_text"), F.expr("replace(p_type, 'ECONOMY', '  ')").alias("kind"))
    out = dimensional.standardised(p, {"p_brand": "brand", "p_partkey": "part_key"}, {"size_text": "string"}, ["kind"], ["kind"], {"kind": "none"}, {"twice": "twice_of * 2"}, ["brand"], [F.col("part_key").desc()])
    return out.drop("twice_of")
