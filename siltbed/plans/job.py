"""One entity's load, from a raw batch to the new target."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions.canonical import record_hash
from siltbed.functions.marks import advanced, mark_text, parsed_mark
from siltbed.functions.masking import anonymise
from siltbed.operators import history, merge, rules
from siltbed.operators.dedup import deduplicate
from siltbed.operators.ordered import cuts
from siltbed.operators.shape import VERSIONED, evolve, projections, table_schema, with_technical
from siltbed.operators.state import batch_max, commit
from siltbed.operators.touched import key_filter
from siltbed.plans.spec import APPEND, DETECT_HASH, HISTORY, MERGE, EntitySpec
from siltbed.sources import landing


@dataclass(frozen=True)
class Load:
    """The new target (None if a rule stopped the load), the report and the batch's mark."""

    target: DataFrame | None
    report: DataFrame
    batch_mark: DataFrame | None
    hash_columns: tuple[str, ...]


def typed_rows(spec: EntitySpec, raw: DataFrame) -> DataFrame:
    """Raw rows typed once, and TYPE_FAILED: rules and load need no more of the raw rows."""
    failed = rules.type_failures(spec.columns, raw).alias(rules.TYPE_FAILED)
    kept = [c for c in spec.sequence if c.lower() not in {x.target.lower() for x in spec.columns}]
    return raw.select(*projections(raw, spec.columns), *kept, failed)


def prepared(spec: EntitySpec, typed: DataFrame, run_id: str, entity_run_id: str, now: str, salts: dict[str, str] | None = None, masking: bool = False) -> DataFrame:
    """Deduplicated, anonymised, hashed rows with technical columns."""
    names = [c.target for c in spec.columns]
    if spec.history:
        kept = [c for c in spec.sequence if c not in names]
        rows = deduplicate(typed.select(*names, *kept), spec.keys, spec.mark, True)
    else:
        rows = deduplicate(typed.drop(rules.TYPE_FAILED), spec.keys, spec.mark, False, spec.sequence).select(*names)
    rows = anonymise(rows, spec.all_masks, salts, masking)
    rows = rows.withColumn("bronze_record_hash", record_hash(rows, spec.hash_columns))
    rows = with_technical(rows, run_id, entity_run_id, now, spec.source_system, spec.source_table)
    if spec.history:
        dated = F.col(spec.mark) if spec.mark and spec.mark_type == "DATETIME" else F.lit(now)
        rows = rows.withColumn("bronze_valid_from", dated.cast("timestamp"))
    return rows


def _evolved(spec: EntitySpec, target: DataFrame, rows: DataFrame) -> DataFrame:
    """The target with the columns that the rows bring."""
    business = {c.target for c in spec.columns}
    wanted = {f.name: f.dataType.simpleString() for f in rows.schema if f.name in business or f.name.startswith("bronze_")} | (VERSIONED if spec.history else {})
    return evolve(target, wanted)


def applied(spec: EntitySpec, target: DataFrame, rows: DataFrame, run_id: str, entity_run_id: str, now: str) -> DataFrame:
    """The target after the rows, by the entity's strategy; new columns of the rows are added."""
    target = _evolved(spec, target, rows)
    if spec.strategy == HISTORY:
        return history.apply(target, rows, spec.keys, [c for c in spec.sequence if c in rows.columns])
    if spec.strategy == MERGE:
        return _merged(spec, target, rows, run_id, entity_run_id, now).drop("_action")
    if spec.strategy == APPEND:
        return merge.append(target, rows, entity_run_id)
    return merge.replace(target, rows)


def _merged(spec: EntitySpec, target: DataFrame, rows: DataFrame, run_id: str, entity_run_id: str, now: str, **options) -> DataFrame:
    stamp = {"bronze_run_id": run_id, "bronze_entity_run_id": entity_run_id, merge.UPDATED: now}
    return merge.merge(target, rows, spec.keys, spec.full_load, spec.soft_delete, spec.change_detection == DETECT_HASH, stamp, **options)


def process(spec: EntitySpec, raw: DataFrame, target: DataFrame, run_id: str, entity_run_id: str, now: str, salts: dict[str, str] | None = None, masking: bool = False, previous_rows: int | None = None, before: object = None, staging: str | None = None, references: dict[str, DataFrame] | None = None) -> Load:
    """Checks, then applies a batch. Order matters: the mark is read before masking, the
    hash is of masked values, and the caller commits the mark last, after its write.

    With `staging`, a path, the typed rows are written there first, stamped with the run,
    and rules and load read them back: the raw batch is read once.
    """
    if wrong := spec.problems():
        raise ValueError(f"{spec.source_table}: " + "; ".join(wrong))
    typed = typed_rows(spec, raw)
    if staging:
        landing.stage(typed, staging, run_id)
        typed = landing.staged(raw.sparkSession.read.parquet(staging), run_id).drop(landing.RUN_COLUMN)
    found = pre_report(spec, typed, raw, previous_rows, before, references)
    if rules.blocks(found):
        return Load(None, found, None, tuple(spec.hash_columns))
    mark = batch_max(typed, spec.mark) if spec.mark else None
    rows = prepared(spec, typed, run_id, entity_run_id, now, salts, masking)
    return Load(applied(spec, target, rows, run_id, entity_run_id, now), found, mark, tuple(spec.hash_columns))


def pre_report(spec: EntitySpec, typed: DataFrame, raw: DataFrame, previous_rows: int | None = None, before: object = None, references: dict[str, DataFrame] | None = None) -> DataFrame:
    """The report of the PRE rules, built-in ones included, on typed rows; of the raw rows only the columns' names are asked for."""
    floor = F.lit(before).cast(typed.schema[spec.mark].dataType) if spec.mark and before is not None else None
    checked = rules.at_stage(rules.effective_rules(spec.rules, bool(spec.keys)), rules.PRE)
    return rules.report(typed, checked, spec.keys, spec.columns, raw, spec.mark, floor, previous_rows, references)


def post_report(spec: EntitySpec, target: DataFrame, references: dict[str, DataFrame] | None = None) -> DataFrame | None:
    """The report of the POST rules on a written target; None if there are none."""
    checked = rules.at_stage(spec.rules, rules.POST)
    return rules.report(target, checked, spec.keys, spec.columns, None, spec.mark, references=references) if checked else None


@dataclass(frozen=True)
class Metrics:
    """What a load did, in rows: read = rejected (by dedup) + inserted + updated + unchanged, but for
    HISTORY, where inserted are new versions, updated are closed ones, and unchanged is what is left of read."""

    read: int
    rejected: int = 0
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    unchanged: int = 0


@dataclass(frozen=True)
class Loaded:
    """The written target (the old one if a rule stopped the load), its reports, the marks after it, and what was done."""

    target: DataFrame | None
    report: DataFrame
    post: DataFrame | None
    marks: DataFrame
    succeeded: bool
    metrics: Metrics | None = None


def load(spec: EntitySpec, raw: DataFrame, root: str, marks: DataFrame, run_id: str, entity_run_id: str, now: str, salts: dict[str, str] | None = None, masking: bool = False, previous_rows: int | None = None, before: object = None, references: dict[str, DataFrame] | None = None, expected_rows: int | None = None, keep: int | None = None) -> Loaded:
    """One entity's whole load below `root`: stage, integrity and PRE rules, the write by strategy,
    POST rules on the target, and last the mark in marks (entity, mark), if nothing failed.

    A run that stops anywhere can be repeated: staging is overwritten, a snapshot or a run's
    folder is seen when it is complete, and the mark moves only from what it was.
    Counts and the batch's mark are observed while staging and target are written; each report is
    one collect. expected_rows: what the extract says it read; keep: older snapshots to keep, all if None.
    """
    if wrong := spec.problems():
        raise ValueError(f"{spec.source_table}: " + "; ".join(wrong))
    spark, home, staging = raw.sparkSession, f"{root.rstrip('/')}/target", f"{root.rstrip('/')}/staging"
    typed = typed_rows(spec, raw)
    seen = Observation()
    watched = [F.count(F.lit(1)).alias("n"), *([F.max(spec.mark).alias("mark")] if spec.mark else [])]
    landing.stage(typed.observe(seen, *watched), staging, run_id)
    told = seen.get
    stage = spark.read.schema(T.StructType([*typed.schema.fields, T.StructField(landing.RUN_COLUMN, T.StringType())])).parquet(staging)
    typed = landing.staged(stage, run_id).drop(landing.RUN_COLUMN)
    whole = rules.integrity_row(stage, run_id, told["n"] if expected_rows is None else expected_rows)
    report = _kept(pre_report(spec, typed, raw, previous_rows, before, references).unionByName(whole))
    if rules.blocks(report):
        return Loaded(current_target(spec, spark, home), report, None, marks, False)
    rows = prepared(spec, typed, run_id, entity_run_id, now, salts, masking)
    written, metrics = _write(spec, typed, rows, home, told["n"], run_id, entity_run_id, now, salts, masking)
    post = post_report(spec, written, references)
    post = _kept(post) if post is not None else None
    good = post is None or not rules.blocks(post)
    if good and spec.mark:
        kind = typed.schema[spec.mark].dataType
        mark = spark.createDataFrame([(told["mark"],)], T.StructType([T.StructField("batch_mark", kind)]))
        marks = committed(spec, marks, mark)
    if keep is not None and spec.strategy != APPEND:
        landing.expire_snapshots(spark, home, keep, f"{history.STATE}={history.NOW}" if spec.history else None)
    return Loaded(written, report, post, marks, good, metrics)


def current_target(spec: EntitySpec, spark: SparkSession, home: str) -> DataFrame | None:
    """The target as it was last written; None before the first load."""
    if spec.strategy == APPEND:
        return landing.read_parts(spark, home, RUN)
    if spec.strategy == HISTORY:
        out = landing.read_states(spark, home, history.STATE, history.NOW)
        return None if out is None else out.drop(history.STATE)
    return landing.read_snapshot(spark, home)


#: The column by whose values a target without keys is stored.
RUN = "bronze_entity_run_id"


def _write(spec: EntitySpec, typed: DataFrame, rows: DataFrame, home: str, read: int, run_id: str, entity_run_id: str, now: str, salts: dict[str, str] | None, masking: bool) -> tuple[DataFrame, Metrics]:
    """Writes the target by strategy; what is read back, and what the write observed.

    APPEND writes this run's folder only. MERGE joins only rows of the target that the batch's keys may
    touch. HISTORY reads current versions and undated or momentary closed ones; closed ones stay where they are.
    """
    spark, done = typed.sparkSession, Observation()
    empty = spark.createDataFrame([], table_schema(spec.columns, spec.history))
    keys = [c.target for c in spec.columns if c.key]
    # the batch's keys, as they are after masking, from the staged rows: no dedup is needed for them
    own = anonymise(typed.select(*keys), {c: m for c, m in spec.all_masks.items() if c in keys}, salts, masking)
    if spec.strategy == APPEND:
        landing.write_part(rows.observe(done, F.count(F.lit(1)).alias("inserted")), home, RUN)
        inserted = done.get["inserted"]
        if not inserted:  # what an earlier try of this run wrote is not overwritten by nothing
            landing.clear_part(spark, home, RUN, entity_run_id)
        out = landing.read_parts(spark, home, RUN)
        return (empty if out is None else out), Metrics(read, read - inserted, inserted)
    if spec.strategy == MERGE:
        target = landing.read_snapshot(spark, home)
        touched = None if target is None or (spec.full_load and spec.soft_delete) else key_filter(own, keys, read, target)
        out = _merged(spec, _evolved(spec, empty if target is None else target, rows), rows, run_id, entity_run_id, now, touched=touched, told=True)
        counts = [*merge.counts(), F.count_if(F.col("_action") == "SAME").alias("unchanged")]
        path = landing.write_snapshot(out.observe(done, *counts).drop("_action"), home)
        got = done.get
        return spark.read.parquet(path), Metrics(read, read - got["inserted"] - got["updated"] - got["unchanged"], **got)
    if spec.strategy == HISTORY:
        return _write_history(spec, typed, rows, own, home, read)
    target = landing.read_snapshot(spark, home)
    out = merge.replace(_evolved(spec, empty if target is None else target, rows), rows)
    path = landing.write_snapshot(out.observe(done, F.count(F.lit(1)).alias("inserted")), home)
    return spark.read.parquet(path), Metrics(read, read - done.get["inserted"], done.get["inserted"])


def _seen(watched: Observation) -> int | None:
    """The count that was observed within a plan; None where an empty side of a join has made that part of it go."""
    try:
        return watched.get["n"]
    except (Py4JJavaError, KeyError):
        return None


def _write_history(spec: EntitySpec, typed: DataFrame, rows: DataFrame, own: DataFrame, home: str, read: int) -> tuple[DataFrame, Metrics]:
    spark, done, kept = typed.sparkSession, Observation(), Observation()
    now, sequence = history.NOW, [c for c in spec.sequence if c in rows.columns]
    current = landing.read_states(spark, home, history.STATE, now, states=[now])
    if current is None:
        current = instants = _evolved(spec, spark.createDataFrame([], table_schema(spec.columns, True)), rows)
        touched = None
    else:
        schema = current.drop(history.STATE).schema
        instants = landing.read_states(spark, home, history.STATE, now, schema, states=[history.INSTANT])
        current, instants = (_evolved(spec, x.drop(history.STATE), rows) for x in (current, instants))
        touched = key_filter(own, spec.keys, read, current)
    # cuts of hot keys are found in the staged rows, by the column that dates versions
    dated = spec.mark if spec.mark and spec.mark_type == "DATETIME" else None
    known = None if any(k in spec.all_masks for k in spec.keys) or not dated else cuts(typed.select(*spec.keys, F.col(dated).cast("timestamp").alias(history.FROM)), spec.keys, [history.FROM])
    rows = rows.observe(kept, F.count(F.lit(1)).alias("n"))
    out = history.advance(current, instants, rows, spec.keys, sequence, touched, known)
    counts = merge.counts()[:2]
    landing.write_snapshot(out.observe(done, *counts).drop("_action"), home, [history.STATE])
    got, left = done.get, _seen(kept)
    left = rows.count() if left is None else left
    written = landing.read_states(spark, home, history.STATE, now, T.StructType([f for f in out.schema if f.name not in ("_action", history.STATE)]))
    return written.drop(history.STATE), Metrics(read, read - left, got["inserted"], got["updated"], 0, left - got["inserted"])


def _kept(few: DataFrame) -> DataFrame:
    """A frame of a row a rule, or of one mark, as values: staging, which it is from, is overwritten by the next run."""
    return few.sparkSession.createDataFrame(few.collect(), few.schema)


def committed(spec: EntitySpec, marks: DataFrame, batch_mark: DataFrame) -> DataFrame:
    """marks (entity, mark) after a batch: advanced, never back, and only where the mark is still what was read."""
    own = marks.where(F.col("entity") == spec.entity_id).select("mark")
    kind = batch_mark.schema["batch_mark"].dataType
    known = batch_mark.select(F.lit(None).cast("string").alias("mark"), "batch_mark").union(own.select("mark", F.lit(None).cast(kind)))
    known = known.agg(F.max("mark").alias("mark"), F.max("batch_mark").alias("batch_mark"))  # of one row each
    new = advanced(parsed_mark(F.col("mark"), spec.mark_type).cast(kind), F.col("batch_mark"))
    proposal = known.select(F.lit(spec.entity_id).cast("long").alias("entity"), F.col("mark").alias("expected"), mark_text(new, spec.mark_type).alias("proposed"))
    return commit(marks, proposal).select("entity", "mark")
