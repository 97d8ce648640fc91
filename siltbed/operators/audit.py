"""Analytics over load events: folds of events to states, roll-ups and views.

Events: runs (run_id, status, start_datetime, end_datetime), entity runs (run_id,
entity_id, attempt, status, …). Nothing is updated in place: the state of a thing
is the last event about it. Whatever depends on the time takes `as_of`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.functions.messages import error_code, is_retryable, scrubbed
from siltbed.operators.dedup import top_per_key
from siltbed.operators.ordered import listed, pieces

SUCCEEDED, FAILED, CANCELLED, PARTIAL = "SUCCEEDED", "FAILED", "CANCELLED", "PARTIAL_SUCCESS"
#: The activities that write a target.
WRITES = ("MERGE_COMPLETED", "HISTORY_COMPLETED", "APPEND_COMPLETED", "REPLACE_COMPLETED")


def run_fold(starts: DataFrame, run: str, at: str) -> DataFrame:
    """A run is STARTED, or RUNNING once the same id starts again."""
    return starts.groupBy(run).agg(F.when(F.count("*") > 1, "RUNNING").otherwise("STARTED").alias("status"), F.min(at).alias("start_datetime"))


def rollup_status(succeeded: Column, failed: Column, cancelled: Column) -> Column:
    return F.when((failed > 0) & (succeeded > 0), PARTIAL).when(failed > 0, FAILED).when(cancelled > 0, CANCELLED).otherwise(SUCCEEDED)


def run_rollup(entity_runs: DataFrame, run: str, status: str) -> DataFrame:
    """Counts by status and the status of each run."""
    n = lambda s: F.count_if(F.col(status) == s)
    out = entity_runs.groupBy(run).agg(n(SUCCEEDED).alias("succeeded"), n(FAILED).alias("failed"), n(CANCELLED).alias("cancelled"), F.count("*").alias("entities"))
    return out.withColumn("run_status", rollup_status(F.col("succeeded"), F.col("failed"), F.col("cancelled")))


def entity_fold(events: DataFrame, keys: Sequence[str], at: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The state of each key: the last value that is not NULL of each column, and attempts.

    An aggregate over (time, value) pairs, so groups combine before the shuffle.
    """
    last = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*at))).alias(c) for c in columns]
    return events.groupBy(*keys).agg(F.count("*").alias("attempts"), *last)


def duration_ms(start: str, end: str) -> Column:
    return F.timestamp_diff("MILLISECOND", F.col(start), F.col(end))


def hours_crossed(start: Column, end: Column) -> Column:
    """Hour boundaries between two times."""
    return F.timestamp_diff("HOUR", F.date_trunc("HOUR", start), F.date_trunc("HOUR", end))


#: The statuses that say a file was read by a run.
PROCESSED = ("PROCESSED", "REPLAYED")


def file_upsert(files: DataFrame, events: DataFrame, keys: Sequence[str], value: str, at: str) -> DataFrame:
    """Files after events: the last event of a (container, path), NULL parts included, sets status and time.

    `file_processing` gives the run and time by which a file was read.
    """
    latest = top_per_key(events, keys, [F.col(at).desc(), F.col(value)]).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(value).alias("_v"), F.col(at).alias("_t"), F.lit(True).alias("_new"))
    out = files.join(latest, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], "full_outer")
    new = F.col("_new").isNotNull()
    return out.select(*[F.when(new, F.col(f"_k{i}")).otherwise(F.col(k)).alias(k) for i, k in enumerate(keys)], F.when(new, F.col("_v")).otherwise(F.col(value)).alias(value), F.when(new, F.col("_t")).otherwise(F.col(at)).alias(at))


def file_processing(events: DataFrame, keys: Sequence[str], status: str, at: str, run: str, processed_run: str | None = None) -> DataFrame:
    """processed_run_id and processed_datetime of each file: of its last PROCESSED or REPLAYED event,
    the run that the event names, or else its own; NULL for files that no run has read."""
    own = F.coalesce(F.col(processed_run), F.col(run)) if processed_run else F.col(run)
    when = F.when(F.col(status).isin(*PROCESSED), F.struct(F.col(at), F.col(run)))
    return events.groupBy(*keys).agg(F.max_by(own, when).alias("processed_run_id"), F.max(when)[at].alias("processed_datetime"))


def error_rows(failures: DataFrame, run: str, entity: str, stage: str, message: str, at: str) -> DataFrame:
    """Rows to append to an error table: run, entity, stage, error code, scrubbed message, whether a retry is
    worth it (in doubt not), and time. The code and the retry are read before the message is scrubbed."""
    code = error_code(F.col(message))
    return failures.select(run, entity, F.col(stage).alias("stage"), code.alias("error_code"), scrubbed(F.col(message)).alias("error_message"), F.coalesce(is_retryable(code, F.col(message)), F.lit(False)).alias("is_retryable"), at)


def baseline(entity_runs: DataFrame, keys: Sequence[str], end: str, staged: str, source: str, exclude: Column | None = None) -> DataFrame:
    """baseline_rows of each entity's last success: rows staged, or else rows read."""
    rows = entity_runs if exclude is None else entity_runs.where(~exclude)
    return rows.groupBy(*keys).agg(F.max_by(F.coalesce(staged, source), F.col(end)).alias("baseline_rows"), F.max(end).alias("baseline_datetime"))


def latest_attempt(entity_runs: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_per_key(entity_runs, keys, order)


def mark_status(successes: DataFrame, keys: Sequence[str], end: str, mark: str, as_of: Column, recent: int = 5) -> DataFrame:
    """Of each entity: last success, hours since, late beyond 24, stale if its last
    `recent` successes are that many and have one mark between them (NULL is none)."""
    order = Window.partitionBy(*keys).orderBy(F.col(end).desc())
    ranked = successes.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= recent)
    first = F.col("_rn") == 1
    out = ranked.groupBy(*keys).agg(F.max(F.when(first, F.col(mark))).alias("latest_watermark"), F.max(end).alias("last_success_datetime"), F.countDistinct(mark).alias("_marks"), F.count("*").alias("_n"))
    hours = hours_crossed(F.col("last_success_datetime"), as_of)
    return out.select(*keys, "latest_watermark", "last_success_datetime", hours.alias("hours_since_last_success"), (hours > 24).cast("int").alias("is_not_loaded_recently"), ((F.col("_marks") == 1) & (F.col("_n") == recent)).cast("int").alias("is_watermark_stale"))


def run_summary(runs: DataFrame, errors: DataFrame, run: str = "run_id") -> DataFrame:
    """runs with duration, whether one still executes, and its number of errors."""
    counts = errors.groupBy(run).agg(F.count("*").alias("error_count"))
    out = runs.join(counts, run, "left").withColumn("error_count", F.coalesce("error_count", F.lit(0)))
    return out.withColumns({"duration_seconds": F.timestamp_diff("SECOND", F.col("start_datetime"), F.col("end_datetime")), "is_executing": F.col("end_datetime").isNull().cast("int")})


def recent(events: DataFrame, at: str, as_of: Column, days: int = 7) -> DataFrame:
    return events.where((F.col(at) >= as_of - F.make_dt_interval(F.lit(days))) & (F.col(at) <= as_of))


def repeated_failures(failures: DataFrame, keys: Sequence[str], at: str, as_of: Column, least: int = 3, days: int = 7) -> DataFrame:
    return recent(failures, at, as_of, days).groupBy(*keys).agg(F.count("*").alias("failure_count"), F.max(at).alias("last_failure_datetime")).where(F.col("failure_count") >= least)


def load_performance(entity_runs: DataFrame, activities: DataFrame, run: str) -> DataFrame:
    """Seconds, rows a second (NULL for 0 ms), and what copies and writes took."""
    spent = activities.groupBy(run).agg(F.sum(F.when(F.col("activity_type").like("COPY%"), F.col("duration_ms"))).alias("copy_duration_ms"), F.sum(F.when(F.col("activity_type").isin(*WRITES), F.col("duration_ms"))).alias("write_duration_ms"))
    ms = duration_ms("start_datetime", "end_datetime")
    out = entity_runs.where(F.col("end_datetime").isNotNull()).join(spent, run, "left")
    return out.withColumns({"duration_seconds": ms / 1000.0, "rows_per_second": F.when(ms > 0, F.col("source_row_count") * 1000.0 / ms)})


def summary_json(entity_runs: DataFrame, run: str, entity: str, status: str) -> DataFrame:
    """Each run's counts and its entities, sorted, as JSON.

    The list is a run's own entities, what the caller asks for: an error beyond ordered.LISTED rows,
    where summary_pieces() goes on.
    """
    rows = entity_runs.select(run, F.col(entity).alias("entity_id"), F.col(status).alias("status"))
    detail = listed(rows, [run], ["entity_id", "status"], ["entity_id", "status"])
    out = _run_counts(rows, run).join(detail, F.col(run).eqNullSafe(F.col("_run")))
    return out.select(run, F.to_json(F.struct("succeeded", "failed", F.col("rows").alias("entities"))).alias("summary"))


def _run_counts(rows: DataFrame, run: str) -> DataFrame:
    return rows.groupBy(F.col(run).alias("_run")).agg(F.count_if(F.col("status") == SUCCEEDED).alias("succeeded"), F.count_if(F.col("status") == FAILED).alias("failed"))


def summary_pieces(entity_runs: DataFrame, run: str, entity: str, status: str, most: int = 1000) -> DataFrame:
    """Each run's summary as JSON in pieces of `most` entities at most: piece 0 has the run's counts, too."""
    rows = entity_runs.select(run, F.col(entity).alias("entity_id"), F.col(status).alias("status"))
    parts = pieces(rows, [run], ["entity_id", "status"], ["entity_id", "status"], most)
    out = parts.join(_run_counts(rows, run), F.col(run).eqNullSafe(F.col("_run")))
    first = F.col("piece") == 0
    counted = F.struct(F.when(first, F.col("succeeded")).alias("succeeded"), F.when(first, F.col("failed")).alias("failed"), F.col("rows").alias("entities"))
    return out.select(run, "piece", F.to_json(counted).alias("summary"))
