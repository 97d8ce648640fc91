"""Registered queries of rules, masks, audit analytics, checks, dimensions and whole loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltbed.functions import masking, messages
from siltbed.functions.masking import MaskRule
from siltbed.operators import audit, checks, dimensional, rules, shape
from siltbed.operators.rules import Rule
from siltbed.operators.shape import ColumnSpec
from siltbed.plans import job, spec
from siltbed.plans.queries import MONEY, NOW, Tables, _scratch, query
from siltbed.sources import landing
from siltbed.streaming import landing_stream as streams

# ---- rules ---------------------------------------------------------------------

KEYS = ["l_orderkey", "l_linenumber"]


def _failures(df, rule, keys=(), **options):
    return df.agg(F.count_if(rules.row_failure(rule, keys, **options)).alias("failed_row_count"))


@query("v_pk_null", "SELECT count(*) FILTER (nullif(l_orderkey, 1) IS NULL OR nullif(l_linenumber, 2) IS NULL) AS failed_row_count FROM lineitem")
def v_pk_null(spark, d):
    df = Tables(spark, d).lineitem.withColumns({"l_orderkey": F.expr("nullif(l_orderkey, 1)"), "l_linenumber": F.expr("nullif(l_linenumber, 2)")})
    return _failures(df, Rule("r", rules.PK_NULL), KEYS)


@query("v_duplicate_pk", "SELECT CAST(sum(n - 1) AS BIGINT) AS failed_row_count FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def v_duplicate_pk(spark, d):
    return rules.surplus(Tables(spark, d).lineitem, KEYS).withColumnRenamed("surplus_rows", "failed_row_count")


@query("v_mandatory_null", "SELECT count(*) FILTER (nullif(l_returnflag, 'A') IS NULL) AS failed_row_count FROM lineitem")
def v_mandatory_null(spark, d):
    return _failures(Tables(spark, d).lineitem.withColumn("l_returnflag", F.expr("nullif(l_returnflag, 'A')")), Rule("r", rules.MANDATORY, "l_returnflag"))


@query("v_column_missing", "SELECT CAST(2 AS BIGINT) AS failed_row_count, count(*) AS row_count FROM lineitem")
def v_column_missing(spark, d):
    df = Tables(spark, d).lineitem
    n = len(shape.missing_columns(df, ["L_ORDERKEY", "l_nothing", "l_tax", "l_none"]))
    return df.agg(F.lit(n).cast("long").alias("failed_row_count"), F.count("*").alias("row_count"))


@query("v_type_mismatch", "SELECT count(*) FILTER (TRY_CAST(o_orderstatus AS DECIMAL(9,0)) IS NULL) AS status_no_number, count(*) FILTER (TRY_CAST(o_orderpriority AS DATE) IS NULL) AS priority_no_date, count(*) FILTER (TRY_CAST(o_orderstatus AS BOOLEAN) IS NULL) AS status_no_boolean FROM orders")
def v_type_mismatch(spark, d):
    cols = {"status_no_number": ColumnSpec("o_orderstatus", "x", "decimal(9,0)"), "priority_no_date": ColumnSpec("o_orderpriority", "x", "date"), "status_no_boolean": ColumnSpec("o_orderstatus", "x", "boolean")}
    return Tables(spark, d).orders.agg(*[F.count_if(rules.type_failure(c)).alias(n) for n, c in cols.items()])


@query("v_watermark_invalid", "SELECT count(*) FILTER (o_orderstatus = 'P' OR o_orderdate < TIMESTAMP '1996-01-01') AS failed_row_count FROM orders")
def v_watermark_invalid(spark, d):
    df = Tables(spark, d).orders.withColumn("o_orderdate", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return _failures(df, Rule("r", rules.MARK), mark="o_orderdate", floor=F.lit("1996-01-01").cast("timestamp_ntz"))


@query("v_row_count_anomaly", "WITH n AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1), c AS (SELECT day, n, (n - lag(n) OVER (ORDER BY day)) * 100.0 / lag(n) OVER (ORDER BY day) AS change FROM n) SELECT day, n, round(CAST(change AS DOUBLE), 6) AS change, coalesce(abs(change) > 5, false) AS is_anomaly FROM c")
def v_row_count_anomaly(spark, d):
    from pyspark.sql import Window

    days = Tables(spark, d).events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    before = F.lag("n").over(Window.orderBy("day"))  # one row a day
    out = days.withColumn("change", rules.row_count_change(F.col("n").cast("double"), before.cast("double")))
    return out.select("day", "n", F.round("change", 6).alias("change"), F.coalesce(F.abs("change") > 5, F.lit(False)).alias("is_anomaly"))


@query("v_custom", "SELECT count(*) FILTER (NOT (nullif(l_discount, 0.05) < 0.08)) AS failed_row_count FROM lineitem")
def v_custom(spark, d):
    return _failures(Tables(spark, d).lineitem, Rule("r", rules.CUSTOM, expression="nullif(l_discount, 0.05D) < 0.08D"))


LINE_RULES = [
    Rule("keys", rules.PK_NULL), Rule("unique", rules.DUPLICATE, action=rules.WARN), Rule("flag", rules.MANDATORY, "l_returnflag"), Rule("present", rules.MISSING),
    Rule("typed", rules.TYPE), Rule("marked", rules.MARK, action=rules.IGNORE), Rule("discount", rules.CUSTOM, expression="l_discount <= 0.08", action=rules.FAIL), Rule("rows", rules.ROW_COUNT, threshold=50.0, action=rules.WARN),
]
LINE_COLUMNS = [ColumnSpec("l_orderkey", "l_orderkey", "bigint", key=True), ColumnSpec("l_linenumber", "l_linenumber", "int", key=True), ColumnSpec("l_returnflag", "l_returnflag", "string"), ColumnSpec("l_linestatus", "l_linestatus", "boolean"), ColumnSpec("l_shipdate", "l_shipdate", "timestamp_ntz", mark=True), ColumnSpec("l_gone", "l_gone", "string")]


@query("v_rule_report", """SELECT 'keys' AS rule_name, 'PRIMARY_KEY_NULL' AS rule_type, 'PASSED' AS status, CAST(0 AS BIGINT) AS failed_row_count
UNION ALL SELECT 'unique', 'DUPLICATE_PRIMARY_KEY', CASE WHEN sum(n - 1) > 0 THEN 'WARNING' ELSE 'PASSED' END, CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'flag', 'MANDATORY_COLUMN_NULL', 'PASSED', 0
UNION ALL SELECT 'present', 'COLUMN_MISSING', 'FAILED', 1
UNION ALL SELECT 'typed', 'DATA_TYPE_MISMATCH', 'FAILED', count(*) FILTER (TRY_CAST(l_linestatus AS BOOLEAN) IS NULL) FROM lineitem
UNION ALL SELECT 'marked', 'WATERMARK_INVALID', 'IGNORED', count(*) FILTER (l_shipdate < TIMESTAMP '1998-01-01') FROM lineitem
UNION ALL SELECT 'discount', 'CUSTOM', 'FAILED', count(*) FILTER (l_discount > 0.08) FROM lineitem
UNION ALL SELECT 'rows', 'ROW_COUNT_ANOMALY', 'WARNING', 1""")
def v_rule_report(spark, d):
    df = Tables(spark, d).lineitem
    raw = df.withColumn("l_linestatus", F.when(F.col("l_linestatus") == "F", "F").otherwise("O"))
    return rules.report(df, LINE_RULES, KEYS, LINE_COLUMNS, raw, "l_shipdate", F.lit("1998-01-01").cast("timestamp_ntz"), previous_rows=10)


@query("threshold_bands", "SELECT l_shipmonth, CASE WHEN f = 0 THEN 'PASS' WHEN f * 1.0 / n <= 0.01 THEN 'WARNING' WHEN f * 1.0 / n <= 0.05 THEN 'ERROR' ELSE 'FAIL' END AS level FROM (SELECT strftime(l_shipdate, '%Y-%m') AS l_shipmonth, count(*) AS n, count(*) FILTER (l_quantity > 49) AS f FROM lineitem GROUP BY 1)")
def threshold_bands(spark, d):
    g = Tables(spark, d).lineitem.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("l_shipmonth")).agg(F.count_if(F.col("l_quantity") > 49).alias("f"), F.count("*").alias("n"))
    return g.select("l_shipmonth", rules.band(F.col("f"), F.col("n")).alias("level"))


@query("quarantine", "SELECT c_custkey, 'balance' AS rule_name FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey, 'segment' FROM customer WHERE c_mktsegment = 'FURNITURE'")
def quarantine(spark, d):
    own = [Rule("balance", rules.CUSTOM, expression="c_acctbal >= 0"), Rule("segment", rules.MANDATORY, "segment")]
    df = Tables(spark, d).customer.withColumn("segment", F.expr("nullif(c_mktsegment, 'FURNITURE')"))
    return rules.quarantine(df, own, [])[1].select("c_custkey", "rule_name")


@query("rule_routing", "SELECT p_partkey, CASE WHEN NOT regexp_full_match(p_brand, 'Brand#[0-9]') THEN 'FAIL' WHEN p_size NOT BETWEEN 5 AND 40 THEN 'REJECT' WHEN p_type = 'PROMO' THEN 'WARNING' ELSE 'PASS' END AS outcome FROM part")
def rule_routing(spark, d):
    own = [rules.pattern("brand", "p_brand", "Brand#[0-9]"), rules.in_range("size", "p_size", 5, 40, rules.REJECT), Rule("type", rules.CUSTOM, expression="p_type <> 'PROMO'", action=rules.WARN)]
    return rules.routed(Tables(spark, d).part, own, []).select("p_partkey", "outcome")


@query("referential_rule", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def referential_rule(spark, d):
    t = Tables(spark, d)
    return checks.orphans(t.lineitem, t.supplier, {"l_suppkey": "s_suppkey"}, F.col("s_acctbal") > 0).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# ---- masks ---------------------------------------------------------------------

_SHA = "sha256('pepper' || c_name)"


def _masked(spark, d, rule, column="c_name", salt="pepper"):
    c = Tables(spark, d).customer
    return c.select("c_custkey", masking.masked(c, column, rule, salt).alias("masked"))


@query("anon_hash", f"SELECT c_custkey, {_SHA} AS masked FROM customer")
def anon_hash(spark, d):
    return _masked(spark, d, MaskRule("HASH"))


@query("anon_hash_email", f"SELECT c_custkey, substr({_SHA}, 1, 10) || '@mail.invalid' AS masked FROM customer")
def anon_hash_email(spark, d):
    return _masked(spark, d, MaskRule("HASH", "EMAIL", {"length": 10, "domain": "mail.invalid"}))


@query("anon_mask", "SELECT c_custkey, CASE WHEN length(c_mktsegment) > 8 THEN repeat('#', length(c_mktsegment) - 8) || right(c_mktsegment, 8) ELSE '' END AS masked FROM customer")
def anon_mask(spark, d):
    return _masked(spark, d, MaskRule("MASK", parameters={"keep_last": 8, "mask_char": "#"}), "c_mktsegment")


@query("anon_redact", "SELECT c_custkey, 'gone' AS masked FROM customer")
def anon_redact(spark, d):
    return _masked(spark, d, MaskRule("REDACT", parameters={"replacement": "gone"}))


@query("anon_tokenize", f"SELECT c_custkey, 'TKN_' || substr({_SHA}, 1, 12) AS masked FROM customer")
def anon_tokenize(spark, d):
    return _masked(spark, d, MaskRule("TOKENIZE"))


@query("anon_nullify", "SELECT c_custkey, CAST(NULL AS DOUBLE) AS masked FROM customer")
def anon_nullify(spark, d):
    return _masked(spark, d, MaskRule("NULLIFY"), "c_acctbal")


@query("anon_custom", "SELECT c_custkey, lower(substr(c_mktsegment, 1, 3)) AS masked FROM customer")
def anon_custom(spark, d):
    return _masked(spark, d, MaskRule("CUSTOM", parameters={"expression": "lower(substr({col}, 1, 3))"}), "c_mktsegment")


@query("anon_plan", f"SELECT c_custkey, {_SHA} AS c_name, repeat('*', length(c_mktsegment)) AS c_mktsegment, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer")
def anon_plan(spark, d):
    plan = {"c_name": MaskRule("HASH"), "c_mktsegment": MaskRule("MASK", parameters={"keep_last": 0}), "c_acctbal": MaskRule("NULLIFY")}
    return masking.anonymise(Tables(spark, d).customer, plan, {"c_name": "pepper"}).select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


@query("scrub_messages", r"SELECT doc_id, substr(regexp_replace(regexp_replace(regexp_replace(text, '''[^'']{3,}''', '''<redacted>''', 'g'), '[\p{L}\p{N}\p{M}_.+-]+@[\p{L}\p{N}\p{M}_-]+\.[\p{L}\p{N}\p{M}_.-]+', '<redacted-email>', 'g'), '\b\d{7,}\b', '<redacted-number>', 'g'), 1, 4000) AS message FROM documents")
def scrub_messages(spark, d):
    return Tables(spark, d).documents.select("doc_id", messages.scrubbed(F.col("text")).alias("message"))


_CODED = "CASE WHEN conv_id % 7 = 0 THEN '08S01:' || turn WHEN conv_id % 7 = 1 THEN '42000:40613' WHEN conv_id % 7 = 2 THEN '42000' END"


@query("error_classify", f"SELECT conv_id, turn, CASE WHEN conv_id % 7 IN (0, 1) THEN true WHEN regexp_matches(text, '(?i)permission|not authorized|login failed|cannot resolve|incorrect syntax|schema mismatch') THEN false ELSE regexp_matches(text, '(?i)timed? ?out|timeout|connection (reset|refused|closed|was forcibly)|temporar(y|ily)|transient|too many requests|\\b429\\b|\\b503\\b|service unavailable|throttl|capacity|socket') END AS is_retryable FROM (SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0 THEN text || ' Timeout expired' WHEN conv_id % 3 = 1 THEN text || ' permission denied after timeout' ELSE text END AS text FROM conversations)")
def error_classify(spark, d):
    c = Tables(spark, d).conversations
    text = F.when(F.col("conv_id") % 3 == 0, F.concat("text", F.lit(" Timeout expired"))).when(F.col("conv_id") % 3 == 1, F.concat("text", F.lit(" permission denied after timeout"))).otherwise(F.col("text"))
    return c.select("conv_id", "turn", messages.is_retryable(F.expr(_CODED), text).alias("is_retryable"))


# ---- audit ---------------------------------------------------------------------

_E = "WITH e AS (SELECT event_id, user_id AS entity_id, strftime(ts, '%Y%m%d') AS run_id, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'CANCELLED' ELSE 'SUCCEEDED' END AS status, ts, CAST(value AS DECIMAL(18,2)) AS n FROM events) "
AS_OF = "2024-01-31 00:00:00"
_asof = lambda: F.lit(AS_OF).cast("timestamp_ntz")


def _audit(t):
    status = F.when(F.col("event_type") == "error", audit.FAILED).when(F.col("event_type") == "signup", audit.CANCELLED).otherwise(audit.SUCCEEDED)
    return t.events.select("event_id", F.col("user_id").alias("entity_id"), F.date_format("ts", "yyyyMMdd").alias("run_id"), status.alias("status"), "ts", F.col("value").cast(MONEY).alias("n"))


@query("audit_run_fold", _E + "SELECT run_id, CASE WHEN count(*) > 1 THEN 'RUNNING' ELSE 'STARTED' END AS status, min(ts) AS start_datetime FROM (SELECT run_id || '-' || entity_id AS run_id, ts FROM e) GROUP BY run_id")
def audit_run_fold(spark, d):
    return audit.run_fold(_audit(Tables(spark, d)).withColumn("run_id", F.concat("run_id", F.lit("-"), F.col("entity_id"))), "run_id", "ts")


@query("audit_run_rollup", _E + ", c AS (SELECT run_id, entity_id % 40 AS g, count(*) FILTER (status = 'SUCCEEDED') AS succeeded, count(*) FILTER (status = 'FAILED') AS failed, count(*) FILTER (status = 'CANCELLED') AS cancelled, count(*) AS entities FROM e GROUP BY ALL) SELECT run_id || '-' || g AS run, succeeded, failed, cancelled, entities, CASE WHEN failed > 0 AND succeeded > 0 THEN 'PARTIAL_SUCCESS' WHEN failed > 0 THEN 'FAILED' WHEN cancelled > 0 THEN 'CANCELLED' ELSE 'SUCCEEDED' END AS run_status FROM c")
def audit_run_rollup(spark, d):
    e = _audit(Tables(spark, d)).withColumn("run", F.concat("run_id", F.lit("-"), F.col("entity_id") % 40))
    return audit.run_rollup(e, "run", "status")


@query("audit_entity_fold", _E + "SELECT run_id, entity_id, count(*) AS attempts, arg_max(status, ts) AS status, arg_max(n, ts) FILTER (status <> 'FAILED') AS n FROM e GROUP BY ALL")
def audit_entity_fold(spark, d):
    e = _audit(Tables(spark, d)).withColumn("n", F.when(F.col("status") != "FAILED", F.col("n")))
    return audit.entity_fold(e, ["run_id", "entity_id"], ["ts"], ["status", "n"])


@query("audit_activity_duration", "SELECT event_id, date_diff('millisecond', ts, ts + INTERVAL 1 SECOND * (event_id % 100) + INTERVAL 250 MILLISECOND) AS duration_ms FROM events")
def audit_activity_duration(spark, d):
    e = Tables(spark, d).events.withColumn("until", F.expr("ts + make_dt_interval(0, 0, 0, event_id % 100 + 0.25)"))
    return e.select("event_id", audit.duration_ms("ts", "until").alias("duration_ms"))


_FILES = _E + ", f AS (SELECT nullif(entity_id, 3) AS container, run_id AS path, 'CREATED' AS status, min(ts) AS at FROM e WHERE ts < TIMESTAMP '2024-01-20' GROUP BY ALL), g AS (SELECT nullif(entity_id, 3) AS container, run_id AS path, arg_max(status, ts) AS status, max(ts) AS at FROM e WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY ALL) "


@query("audit_file_upsert", _FILES + "SELECT coalesce(g.container, f.container) AS container, coalesce(g.path, f.path) AS path, coalesce(g.status, f.status) AS status, coalesce(g.at, f.at) AS at FROM f FULL JOIN g ON f.container IS NOT DISTINCT FROM g.container AND f.path = g.path")
def audit_file_upsert(spark, d):
    e = _audit(Tables(spark, d)).withColumn("container", F.expr("nullif(entity_id, 3L)")).withColumnsRenamed({"run_id": "path", "ts": "at"})
    files = e.where("at < timestamp_ntz'2024-01-20'").groupBy("container", "path").agg(F.lit("CREATED").alias("status"), F.min("at").alias("at"))
    return audit.file_upsert(files, e.where("at >= timestamp_ntz'2024-01-10'"), ["container", "path"], "status", "at")


@query("audit_run_entities", _E + "SELECT event_id, entity_id FROM e WHERE run_id = '20240110' AND status = 'FAILED'")
def audit_run_entities(spark, d):
    return _audit(Tables(spark, d)).where("run_id = '20240110' and status = 'FAILED'").orderBy("entity_id", "event_id").select("event_id", "entity_id")


@query("audit_baseline", _E + "SELECT entity_id, arg_max(n, ts) AS baseline_rows, max(ts) AS baseline_datetime FROM e WHERE status = 'SUCCEEDED' AND run_id <> '20240130' GROUP BY entity_id")
def audit_baseline(spark, d):
    e = _audit(Tables(spark, d)).where("status = 'SUCCEEDED'").withColumn("staged", F.when(F.col("event_id") % 2 == 0, F.col("n")))
    return audit.baseline(e, ["entity_id"], "ts", "staged", "n", F.col("run_id") == "20240130")


_RUNS = ", r AS (SELECT run_id, min(ts) AS start_datetime, CASE WHEN run_id < '20240129' THEN max(ts) END AS end_datetime FROM e GROUP BY run_id) "


def _runs(e):
    return e.groupBy("run_id").agg(F.min("ts").alias("start_datetime"), F.max(F.when(F.col("run_id") < "20240129", F.col("ts"))).alias("end_datetime"))


@query("vw_run_summary", _E + _RUNS + "SELECT r.run_id, start_datetime, end_datetime, CASE WHEN end_datetime IS NULL THEN 1 ELSE 0 END AS is_executing, date_sub('second', start_datetime, end_datetime) AS duration_seconds, coalesce(x.n, 0) AS error_count FROM r LEFT JOIN (SELECT run_id, count(*) AS n FROM e WHERE status = 'FAILED' GROUP BY 1) x ON r.run_id = x.run_id")
def vw_run_summary(spark, d):
    e = _audit(Tables(spark, d))
    return audit.run_summary(_runs(e), e.where("status = 'FAILED'"))


@query("vw_entity_status", _E + "SELECT entity_id, run_id, status, ts FROM e QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY ts DESC) = 1")
def vw_entity_status(spark, d):
    return audit.latest_attempt(_audit(Tables(spark, d)), ["entity_id"], [F.col("ts").desc()]).select("entity_id", "run_id", "status", "ts")


@query("vw_recent_errors", _E + f"SELECT event_id, entity_id, run_id, ts FROM e WHERE status = 'FAILED' AND ts BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND TIMESTAMP '{AS_OF}'")
def vw_recent_errors(spark, d):
    e = _audit(Tables(spark, d)).where("status = 'FAILED'")
    return audit.recent(e, "ts", _asof()).select("event_id", "entity_id", "run_id", "ts")


@query("vw_watermark_status", _E + f", s AS (SELECT entity_id, ts, CASE WHEN entity_id % 10 = 0 THEN 'same' WHEN event_id % 3 > 0 THEN run_id END AS mark, row_number() OVER (PARTITION BY entity_id ORDER BY ts DESC) AS rn FROM e WHERE status = 'SUCCEEDED'), h AS (SELECT entity_id, max(mark) FILTER (rn = 1) AS latest_watermark, max(ts) AS last_success_datetime, count(DISTINCT mark) AS m, count(*) AS n FROM s WHERE rn <= 5 GROUP BY entity_id) SELECT entity_id, latest_watermark, last_success_datetime, date_diff('hour', last_success_datetime, TIMESTAMP '{AS_OF}') AS hours_since_last_success, CAST(date_diff('hour', last_success_datetime, TIMESTAMP '{AS_OF}') > 24 AS INTEGER) AS is_not_loaded_recently, CAST(m = 1 AND n = 5 AS INTEGER) AS is_watermark_stale FROM h")
def vw_watermark_status(spark, d):
    e = _audit(Tables(spark, d)).where("status = 'SUCCEEDED'")
    e = e.withColumn("mark", F.when(F.col("entity_id") % 10 == 0, "same").when(F.col("event_id") % 3 > 0, F.col("run_id")))
    return audit.mark_status(e, ["entity_id"], "ts", "mark", _asof())


@query("vw_validation_failures", _E + _RUNS + "SELECT event_id, e.run_id, r.start_datetime, n_name FROM e JOIN r ON e.run_id = r.run_id JOIN nation ON n_nationkey = entity_id % 25 WHERE status IN ('FAILED', 'CANCELLED')")
def vw_validation_failures(spark, d):
    t = Tables(spark, d)
    e = _audit(t)
    out = e.where(F.col("status").isin("FAILED", "CANCELLED")).join(_runs(e).select("run_id", "start_datetime"), "run_id")
    return out.join(t.nation, F.col("n_nationkey") == F.col("entity_id") % 25).select("event_id", "run_id", "start_datetime", "n_name")


@query("vw_load_performance", "WITH a AS (SELECT l_orderkey, CAST(sum(l_quantity) FILTER (l_returnflag = 'A') AS BIGINT) AS copy_duration_ms, CAST(sum(l_quantity) FILTER (l_returnflag = 'R') AS BIGINT) AS write_duration_ms FROM lineitem GROUP BY 1) SELECT o_orderkey, copy_duration_ms, write_duration_ms, (o_custkey % 50) / 1000.0 AS duration_seconds, CASE WHEN o_custkey % 50 > 0 THEN round(o_orderkey * 1000.0 / (o_custkey % 50), 6) END AS rows_per_second FROM orders LEFT JOIN a ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'")
def vw_load_performance(spark, d):
    t = Tables(spark, d)
    end = F.expr("o_orderdate + make_dt_interval(0, 0, 0, (o_custkey % 50) / 1000.0)")
    runs = t.orders.select("o_orderkey", F.col("o_orderdate").alias("start_datetime"), F.when(F.col("o_orderstatus") != "P", end).alias("end_datetime"), F.col("o_orderkey").alias("source_row_count"))
    kind = F.when(F.col("l_returnflag") == "A", "COPY_LANDING").when(F.col("l_returnflag") == "R", "MERGE_COMPLETED").otherwise("OTHER")
    acts = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), kind.alias("activity_type"), F.col("l_quantity").cast("long").alias("duration_ms"))
    return audit.load_performance(runs, acts, "o_orderkey").select("o_orderkey", "copy_duration_ms", "write_duration_ms", F.col("duration_seconds").cast("double").alias("duration_seconds"), F.round(F.col("rows_per_second").cast("double"), 6).alias("rows_per_second"))


@query("vw_repeated_failures", _E + f"SELECT entity_id, count(*) AS failure_count, max(ts) AS last_failure_datetime FROM e WHERE status = 'FAILED' AND ts BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AND TIMESTAMP '{AS_OF}' GROUP BY 1 HAVING count(*) >= 3")
def vw_repeated_failures(spark, d):
    return audit.repeated_failures(_audit(Tables(spark, d)).where("status = 'FAILED'"), ["entity_id"], "ts", _asof())


@query("vw_landing_files", _E + ", g AS (SELECT nullif(entity_id, 3) AS container, run_id AS path, arg_max(status, ts) AS status, max(ts) AS at FROM e GROUP BY ALL) SELECT g.container, g.path, g.status, g.at AS at, g.status IN ('CREATED', 'FAILED') AS is_replayable FROM g")
def vw_landing_files(spark, d):
    e = _audit(Tables(spark, d)).groupBy(F.expr("nullif(entity_id, 3L)").alias("container"), F.col("run_id").alias("path")).agg(F.max_by("status", "ts").alias("status"), F.max("ts").alias("at"))
    return e.withColumn("is_replayable", F.col("status").isin("CREATED", "FAILED"))


@query("run_summary_json", _E + "SELECT run_id, '{\"succeeded\":' || count(*) FILTER (status = 'SUCCEEDED') || ',\"failed\":' || count(*) FILTER (status = 'FAILED') || ',\"entities\":[' || string_agg('{\"entity_id\":' || entity_id || ',\"status\":\"' || status || '\"}', ',' ORDER BY entity_id, status) || ']}' AS summary FROM e GROUP BY run_id")
def run_summary_json(spark, d):
    return audit.summary_json(_audit(Tables(spark, d)), "run_id", "entity_id", "status")


# ---- checks --------------------------------------------------------------------


@query("check_orphan_fk", "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)")
def check_orphan_fk(spark, d):
    t = Tables(spark, d)
    return checks.orphans(t.orders, t.customer, {"o_custkey": "c_custkey"}, F.col("c_acctbal") >= 0).select("o_orderkey", "o_custkey")


@query("check_childless_parent", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def check_childless_parent(spark, d):
    t = Tables(spark, d)
    return checks.childless(t.customer, t.orders, {"c_custkey": "o_custkey"}, F.col("o_orderstatus") == "P").select("c_custkey")


@query("check_blank_required", "SELECT c_custkey, 'segment' AS column_name FROM customer WHERE c_mktsegment IN ('FURNITURE', 'BUILDING') UNION ALL SELECT c_custkey, 'c_name' FROM customer WHERE c_custkey % 11 = 0")
def check_blank_required(spark, d):
    c = Tables(spark, d).customer.withColumns({"segment": F.expr("CASE c_mktsegment WHEN 'FURNITURE' THEN '  ' WHEN 'BUILDING' THEN NULL ELSE c_mktsegment END"), "c_name": F.expr("CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_name END")})
    return checks.blank(c, ["segment", "c_name"]).select("c_custkey", "column_name")


@query("check_list_members", "SELECT p_partkey, m AS member FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS m FROM part) WHERE m NOT IN (SELECT string_split(p_name, ' ')[2] FROM part WHERE p_size > 0)")
def check_list_members(spark, d):
    p = Tables(spark, d).part
    reference = p.where("p_size > 0").select(F.split("p_name", " ")[1].alias("noun"))
    return checks.list_strangers(p, "p_name", " ", reference, "noun").select("p_partkey", "member")


@query("check_flag_vs_list", "SELECT p_partkey FROM part WHERE (p_size > 25) <> list_contains(string_split(p_name, ' '), 'red')")
def check_flag_vs_list(spark, d):
    return checks.flag_disagrees(Tables(spark, d).part, F.col("p_size") > 25, "p_name", " ", F.lit("red")).select("p_partkey")


@query("check_conditional_def", "SELECT o_orderkey FROM orders WHERE o_orderstatus NOT IN ('O', 'F') OR o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)")
def check_conditional_def(spark, d):
    t = Tables(spark, d)
    defs = t.customer.where("c_nationkey < 20").select(F.col("c_custkey").alias("o_custkey"))
    return checks.undefined(t.orders, "o_orderstatus", ["O", "F"], defs, "o_custkey").select("o_orderkey")


@query("check_row_rule", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT (l_discount < 0.1 OR l_quantity < 40)")
def check_row_rule(spark, d):
    return checks.breaking(Tables(spark, d).lineitem, (F.col("l_discount") < 0.1) | (F.col("l_quantity") < 40)).select("l_orderkey", "l_linenumber", "l_partkey")


@query("check_derived_flag", "WITH f AS (SELECT o_orderkey, o_orderstatus = 'O' AS flag, coalesce(bool_or(l_linestatus = 'O'), false) AS derived_flag FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL) SELECT o_orderkey, derived_flag FROM f WHERE flag <> derived_flag")
def check_derived_flag(spark, d):
    t = Tables(spark, d)
    return checks.derived_flag(t.orders, t.lineitem, {"o_orderkey": "l_orderkey"}, F.col("o_orderstatus") == "O", F.col("l_linestatus") == "O").select("o_orderkey", "derived_flag")


@query("check_enum", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW')")
def check_enum(spark, d):
    return checks.not_in(Tables(spark, d).orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"]).select("o_orderkey", "o_orderpriority")


@query("check_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def check_unique(spark, d):
    return checks.repeated(Tables(spark, d).lineitem, KEYS)


@query("check_grid_completeness", "WITH r AS (SELECT c_nationkey, c_mktsegment || '-' || (c_custkey % 6) AS segment FROM customer) SELECT * FROM (SELECT DISTINCT c_nationkey FROM r) CROSS JOIN (SELECT DISTINCT segment FROM r) EXCEPT SELECT c_nationkey, segment FROM r")
def check_grid_completeness(spark, d):
    c = Tables(spark, d).customer.select("c_nationkey", F.concat("c_mktsegment", F.lit("-"), F.col("c_custkey") % 6).alias("segment"))
    return checks.grid_gaps(c, "c_nationkey", "segment")


# ---- dimensions ----------------------------------------------------------------


@query("reference_lookup", "SELECT s_suppkey, coalesce(n_name, 'unknown') AS nation FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey < 3")
def reference_lookup(spark, d):
    t = Tables(spark, d)
    return dimensional.looked_up(t.supplier.select("s_suppkey", "s_nationkey"), t.nation.where("n_regionkey < 3"), {"s_nationkey": "n_nationkey"}, "n_name", F.lit("unknown"), "nation").drop("s_nationkey")


@query("change_feed_apply", "WITH l AS (SELECT user_id, event_type, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10' QUALIFY row_number() OVER (PARTITION BY user_id % 120 ORDER BY ts DESC) = 1), t AS (SELECT DISTINCT user_id % 120 + 20 AS k, 'old' AS v FROM events) SELECT k, v FROM t WHERE k NOT IN (SELECT user_id % 120 FROM l) UNION ALL SELECT user_id % 120, event_type FROM l WHERE event_type <> 'error'")
def change_feed_apply(spark, d):
    e = Tables(spark, d).events
    target = e.select((F.col("user_id") % 120 + 20).alias("k"), F.lit("old").alias("v")).distinct()
    op = F.when(F.col("event_type") == "error", "DELETE").when(F.col("event_type") == "signup", "INSERT").otherwise("UPDATE")
    feed = e.where("ts >= timestamp_ntz'2024-01-10'").select((F.col("user_id") % 120).alias("k"), F.col("event_type").alias("v"), op.alias("op"), "ts")
    return dimensional.apply_changes(target, feed, ["k"], "op", ["ts"])


@query("dimension_facts", "WITH v AS (SELECT user_id, ts AS since, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS until, event_id AS version FROM events WHERE event_type = 'signup') SELECT e.event_id, v.version, sha256(CAST(e.user_id AS VARCHAR)) AS user_key FROM events e LEFT JOIN v ON e.user_id = v.user_id AND e.ts >= v.since AND (v.until IS NULL OR e.ts < v.until) WHERE e.event_type = 'purchase'")
def dimension_facts(spark, d):
    from siltbed.operators import history

    e = Tables(spark, d).events
    v = history.intervals(e.where("event_type = 'signup'").select("user_id", F.col("ts").alias("since"), F.col("event_id").alias("version")), ["user_id"], ["since"], "since", "until", "cur").drop("cur")
    out = dimensional.as_of_join(e.where("event_type = 'purchase'"), v, ["user_id"], "ts", "since", "until")
    return out.select("event_id", "version", dimensional.surrogate_key("user_id").alias("user_key"))


@query("standard_cleansing", "SELECT c_custkey, coalesce(nullif(trim(CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE ' ' || c_mktsegment || ' ' END), ''), 'none') AS segment FROM customer")
def standard_cleansing(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", F.expr("CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE ' ' || c_mktsegment || ' ' END").alias("segment"))
    return dimensional.cleansed(c, ["segment"], ["segment"], {"segment": "none"})


# ---- whole loads ---------------------------------------------------------------

LINE_SPEC = spec.EntitySpec(
    1, "erp", "lineitem",
    [ColumnSpec("L_ORDERKEY", "l_orderkey", "bigint", key=True), ColumnSpec("L_LINENUMBER", "l_linenumber", "int", key=True), ColumnSpec("l_quantity", "l_quantity", MONEY), ColumnSpec("l_extendedprice", "l_extendedprice", MONEY), ColumnSpec("l_discount", "l_discount", MONEY), ColumnSpec("l_partkey", "l_partkey", "bigint"), ColumnSpec("l_shipdate", "l_shipdate", "timestamp_ntz", mark=True, hashed=False)],
    mark_type="DATETIME",
    rules=[Rule("builtin", rules.DUPLICATE, action=rules.WARN), Rule("quantity", rules.CUSTOM, expression="l_quantity > 0"), Rule("mark", rules.MARK, action=rules.WARN)],
)
_L = "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, CAST(l_discount AS DECIMAL(18,2)) AS l_discount, l_partkey, l_shipdate FROM lineitem"
_L_HASH = "sha256(concat_ws(chr(31), CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR), CAST(l_discount AS VARCHAR), CAST(l_partkey AS VARCHAR)))"


@query("entity_e2e", f"SELECT *, {_L_HASH} AS bronze_record_hash, 'ACTIVE' AS bronze_record_status, 'run-2' AS bronze_run_id FROM ({_L}) QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_partkey DESC) = 1")
def entity_e2e(spark, d):
    """Text rows through staging, rules, dedup, hash and merge into an empty target."""
    line = Tables(spark, d).lineitem
    raw = line.select(*[F.col(c).cast("string").alias(c) for c in line.columns])
    target = spark.createDataFrame([], shape.table_schema(LINE_SPEC.columns))
    load = job.process(LINE_SPEC, raw, target, "run-2", "run-2-E1", NOW, staging=_scratch(spark, "staging"))
    return load.target.select(*[c.target for c in LINE_SPEC.columns], "bronze_record_hash", "bronze_record_status", "bronze_run_id")


@query("landing_stream", "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CASE WHEN event_id % 2 = 0 THEN 'batch-00000000' ELSE 'batch-00000001' END AS bronze_entity_run_id FROM events")
def landing_stream(spark, d):
    """Two landing files through a file stream, one micro-batch each, appended to a target by run."""
    root = _scratch(spark, "stream")
    e = Tables(spark, d).events
    path = f"{root}/target"

    def load(batch, entity_run_id):
        # the folder of a run is replaced when its batch is tried again
        batch.write.mode("overwrite").parquet(f"{path}/bronze_entity_run_id={entity_run_id}")

    for half in (0, 1):
        e.where(F.col("event_id") % 2 == half).write.json(f"{root}/in/part={half}")
        stream = streams.landing_stream(spark, f"{root}/in/*", ["event_id", "event_type"])
        streams.load_available(stream, f"{root}/checkpoint", load).awaitTermination()
    return spark.read.parquet(path).select("event_id", "event_type", F.col("bronze_entity_run_id").cast("string"))


@query("landing_stream_load", "SELECT event_id, event_type, CASE WHEN event_id % 6 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS ts, CASE WHEN event_id % 6 = 0 OR event_id % 2 = 1 THEN 'batch-00000001' ELSE 'batch-00000000' END AS bronze_run_id FROM (SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'again' ELSE event_type END AS event_type, ts FROM events)")
def landing_stream_load(spark, d):
    """Two landing files, one micro-batch each, both through a whole load: staging, rules, merge, mark."""
    root = _scratch(spark, "stream")
    e = Tables(spark, d).events.select("event_id", "event_type", "ts")
    text = lambda df: df.select(F.col("event_id").cast("string").alias("event_id"), "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))
    again = e.where("event_id % 6 = 0").withColumns({"event_type": F.lit("again"), "ts": F.col("ts") + F.make_dt_interval(F.lit(1))})
    for n, rows in enumerate((e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1").union(again))):
        text(rows).write.json(f"{root}/in/part={n}")
        stream = streams.landing_stream(spark, f"{root}/in/*", ["event_id", "event_type", "ts"])
        streams.load_stream(EVENT_SPEC, stream, f"{root}/load", f"{root}/checkpoint", lambda run: NOW).awaitTermination()
    return job.current_target(EVENT_SPEC, spark, f"{root}/load/target").select("event_id", "event_type", "ts", "bronze_run_id")


EVENT_SPEC = spec.EntitySpec(
    3, "app", "events",
    [ColumnSpec("event_id", "event_id", "bigint", key=True), ColumnSpec("event_type", "event_type", "string"), ColumnSpec("ts", "ts", "timestamp_ntz", mark=True, hashed=False)],
    mark_type="DATETIME",
)


@query("run_summary_pieces", _E + ", r AS (SELECT *, (row_number() OVER (PARTITION BY run_id ORDER BY entity_id, status) - 1) // 50 AS piece FROM e), c AS (SELECT run_id, count(*) FILTER (status = 'SUCCEEDED') AS s, count(*) FILTER (status = 'FAILED') AS f FROM e GROUP BY 1) SELECT run_id, CAST(piece AS BIGINT) AS piece, '{' || CASE WHEN piece = 0 THEN '\"succeeded\":' || any_value(s) || ',\"failed\":' || any_value(f) || ',' ELSE '' END || '\"entities\":[' || string_agg('{\"entity_id\":' || entity_id || ',\"status\":\"' || status || '\"}', ',' ORDER BY entity_id, status) || ']}' AS summary FROM r JOIN c USING (run_id) GROUP BY run_id, piece")
def run_summary_pieces(spark, d):
    """Summaries of runs of any number of entities, in pieces of 50."""
    return audit.summary_pieces(_audit(Tables(spark, d)), "run_id", "entity_id", "status", 50)
