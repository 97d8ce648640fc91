"""Data-quality rules: any number of them in one aggregate, a report, and a gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.functions.canonical import quoted
from siltbed.operators.dedup import surplus
from siltbed.operators.shape import ColumnSpec, missing_columns

PK_NULL, DUPLICATE, MANDATORY, MISSING, TYPE, MARK, ROW_COUNT, CUSTOM, UNIQUE, LOOKUP = "PRIMARY_KEY_NULL", "DUPLICATE_PRIMARY_KEY", "MANDATORY_COLUMN_NULL", "COLUMN_MISSING", "DATA_TYPE_MISMATCH", "WATERMARK_INVALID", "ROW_COUNT_ANOMALY", "CUSTOM", "UNIQUE", "LOOKUP"
STAGING = "STAGING_INTEGRITY"
PRE, POST, BOTH = "PRE", "POST", "BOTH"
#: Column of rows typed beforehand: the target columns that could not be converted.
TYPE_FAILED = "_type_failed"
FAIL, REJECT, WARN, IGNORE = "FAIL", "REJECT", "WARN", "IGNORE"


@dataclass(frozen=True)
class Rule:
    """A rule on a column, an expression or the row count; what its failure does.

    stage: PRE is checked on the batch before the write, POST on the target after it.
    UNIQUE is on `columns`; LOOKUP asks for the column's values in another table's
    (`reference`, a name, and `columns`, one column of it).
    """

    name: str
    type: str
    column: str | None = None
    expression: str | None = None
    action: str = FAIL
    threshold: float = 50.0
    stage: str = PRE
    columns: tuple[str, ...] = ()
    reference: str | None = None


def at_stage(rules: Sequence[Rule], stage: str) -> list[Rule]:
    """The rules that are checked at a stage, in their order."""
    return [r for r in rules if r.stage in (stage, BOTH)]


def unmatched(df: DataFrame, column: str, reference: DataFrame, other: str) -> DataFrame:
    """Rows whose value is there and stands nowhere in the other table's column."""
    known = reference.select(F.col(quoted(other)).alias("_known")).distinct()
    return df.where(F.col(quoted(column)).isNotNull()).join(known, F.col(quoted(column)) == F.col("_known"), "left_anti")


def pattern(name: str, column: str, regex: str, action: str = FAIL) -> Rule:
    """A value that is there matches the whole pattern."""
    text = regex.replace("\\", "\\\\").replace("'", "\\'")
    return Rule(name, CUSTOM, column, f"{quoted(column)} IS NULL OR {quoted(column)} RLIKE '^(?:{text})$'", action)


def in_range(name: str, column: str, least: object = None, most: object = None, action: str = FAIL) -> Rule:
    """A value that is there is within the bounds, both inclusive; they are SQL literals."""
    bounds = [f"{quoted(column)} {sign} {v}" for sign, v in ((">=", least), ("<=", most)) if v is not None]
    return Rule(name, CUSTOM, column, f"{quoted(column)} IS NULL OR ({' AND '.join(bounds) or 'TRUE'})", action)


def routed(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """df and outcome: FAIL, REJECT, WARNING or PASS, the worst of the row's failures."""
    def any_of(action: str) -> Column:
        out = F.lit(False)
        for r in rules:
            if r.action == action:
                out = out | F.coalesce(row_failure(r, keys), F.lit(False))
        return out

    return df.withColumn("outcome", F.when(any_of(FAIL), "FAIL").when(any_of(REJECT), "REJECT").when(any_of(WARN), "WARNING").otherwise("PASS"))


def effective_rules(rules: Sequence[Rule], has_key: bool) -> list[Rule]:
    """Adds the built-in rules that no rule of the same type replaces; a type rule for
    one column does not replace the one for all."""
    given = {r.type for r in rules if not (r.type == TYPE and r.column)}
    built_in = [Rule("builtin_" + t.lower(), t) for t in ((PK_NULL, DUPLICATE) if has_key else ()) + (MISSING, TYPE)]
    return [*(r for r in built_in if r.type not in given), *rules]


def row_failure(rule: Rule, keys: Sequence[str], mark: str | None = None, floor: Column | None = None) -> Column:
    """Whether a row fails a rule that looks at one row; NULL of a custom rule is no failure."""
    if rule.type == PK_NULL:
        out = F.lit(False)
        for k in keys:
            out = out | F.col(quoted(k)).isNull()
        return out
    if rule.type == MANDATORY:
        return F.col(quoted(rule.column)).isNull()
    if rule.type == MARK:
        own = F.col(quoted(mark))
        return own.isNull() if floor is None else own.isNull() | (own < floor)
    if rule.type == CUSTOM:
        return ~F.expr(rule.expression)
    raise ValueError(f"{rule.type} looks at more than one row")


def type_failure(column: ColumnSpec) -> Column:
    """On raw rows: a value is there, its conversion is not."""
    raw = F.col(quoted(column.source))
    value = F.expr(column.mapping) if column.mapping else raw
    return raw.isNotNull() & value.try_cast(column.type).isNull()


def type_failures(columns: Sequence[ColumnSpec], raw: DataFrame) -> Column:
    """On raw rows: the target columns whose value is there and can't be converted."""
    absent = missing_columns(raw, [c.source for c in columns if not c.mapping])
    typed = [c for c in columns if c.type.lower() != "string" and c.source not in absent]
    return F.array_compact(F.array(*[F.when(type_failure(c), F.lit(c.target)) for c in typed])) if typed else F.array().cast("array<string>")


def row_count_change(current: Column, previous: Column) -> Column:
    """Per cent against the last success; 0 before is 0 or 100; NULL if there is none."""
    return F.when(previous == 0, F.when(current == 0, 0.0).otherwise(100.0)).otherwise((current - previous) * 100.0 / previous)


def staging_integrity(staged: DataFrame, run_id: str, expected: int, run_column: str = "_staging_run_id") -> DataFrame:
    """One row: total_rows, run_rows, is_consistent: only this run's rows, as many as expected."""
    out = staged.agg(F.count("*").alias("total_rows"), F.count_if(F.col(run_column) == run_id).alias("run_rows"))
    return out.withColumn("is_consistent", (F.col("total_rows") == F.col("run_rows")) & (F.col("run_rows") == expected))


def integrity_row(staged: DataFrame, run_id: str, expected: int, run_column: str = "_staging_run_id") -> DataFrame:
    """staging_integrity() as a row of a report: how many rows are of another run, lacking or too many; any of them is a failure."""
    found = staging_integrity(staged, run_id, expected, run_column)
    off = F.col("total_rows") - F.col("run_rows") + F.abs(F.col("run_rows") - F.lit(expected))
    state = F.when(F.col("is_consistent"), "PASSED").otherwise("FAILED")
    return found.select(F.lit("staging_integrity").alias("rule_name"), F.lit(STAGING).alias("rule_type"), state.alias("status"), off.cast("long").alias("failed_row_count"))


def status(failed: Column, action: Column) -> Column:
    return F.when(failed == 0, "PASSED").when(action == FAIL, "FAILED").when(action == WARN, "WARNING").otherwise("IGNORED")


def report(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str], columns: Sequence[ColumnSpec] = (), raw: DataFrame | None = None, mark: str | None = None, floor: Column | None = None, previous_rows: int | None = None, references: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """rule_name, rule_type, status, failed_row_count of each rule.

    All rules on single rows are one aggregate over df, type rules one over the raw
    rows, a rule on duplicates one grouping; nothing is scanned once per rule. Rows
    that have TYPE_FAILED say themselves what could not be converted.
    """
    spark = df.sparkSession
    raw = df if raw is None else raw
    absent = missing_columns(raw, [c.source for c in columns if not c.mapping])
    per_row, per_raw, parts = {}, {}, []
    for i, r in enumerate(rules):
        if r.type == MISSING:
            names = [r.column] if r.column else [c.source for c in columns if not c.mapping]
            per_row[i] = F.lit(len(missing_columns(raw, names))).cast("long")
        elif r.type == TYPE:
            own = [c for c in columns if (c.target == r.column if r.column else c.type.lower() != "string") and c.source not in absent]
            told = TYPE_FAILED in df.columns
            bad = F.lit(0).cast("long")
            for c in own:
                bad = bad + F.count_if(F.array_contains(TYPE_FAILED, c.target) if told else type_failure(c))
            (per_row if told else per_raw)[i] = bad if own else F.max(F.lit(0)).cast("long")
        elif r.type in (DUPLICATE, UNIQUE):
            parts.append(surplus(df, keys if r.type == DUPLICATE else r.columns).select(F.lit(i).alias("i"), F.col("surplus_rows").alias("n")))
        elif r.type == LOOKUP:
            lost = unmatched(df, r.column, references[r.reference], r.columns[0])
            parts.append(lost.agg(F.count("*").alias("n")).select(F.lit(i).alias("i"), "n"))
        elif r.type == ROW_COUNT:
            change = row_count_change(F.count("*").cast("double"), F.lit(previous_rows).cast("double"))
            per_row[i] = F.when(F.abs(change) > r.threshold, 1).otherwise(0).cast("long")
        else:
            per_row[i] = F.count_if(row_failure(r, keys, mark, floor))

    def unpivoted(frame: DataFrame, counts: dict[int, Column]) -> DataFrame:
        wide = frame.agg(F.count("*").alias("_rows"), *[c.alias(f"r{i}") for i, c in counts.items()])
        return wide.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"r{i}").alias("n")) for i in counts])))

    parts += [unpivoted(frame, counts) for frame, counts in ((df, per_row), (raw, per_raw)) if counts]
    names = spark.createDataFrame([(i, r.name, r.type, r.action) for i, r in enumerate(rules)], "i int, rule_name string, rule_type string, action string")
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.union(p)
    out = names.join(counts, "i").withColumn("status", status(F.col("n"), F.col("action")))
    return out.select("rule_name", "rule_type", "status", F.col("n").cast("long").alias("failed_row_count"))


def is_blocking(state: Column) -> Column:
    """Whether a rule's status stops the load."""
    return state == "FAILED"


def blocks(reported: DataFrame, fail_on_error: bool = True) -> bool:
    """Whether a rule failed that stops the load; reads one row a rule."""
    return fail_on_error and not reported.where(is_blocking(F.col("status"))).isEmpty()


def band(failed: Column, total: Column) -> Column:
    """Share of failed rows as a level: PASS, WARNING to 1 %, ERROR to 5 %, FAIL beyond."""
    share = failed / total
    return F.when((failed == 0) | (total == 0), "PASS").when(share <= 0.01, "WARNING").when(share <= 0.05, "ERROR").otherwise("FAIL")


def quarantine(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that fail no row rule; and a row for each failing row and rule, with rule_name."""
    failed = F.array_compact(F.array(*[F.when(row_failure(r, keys), F.lit(r.name)) for r in rules]))
    tagged = df.withColumn("_failed", failed)
    return tagged.where(F.size("_failed") == 0).drop("_failed"), tagged.withColumn("rule_name", F.explode("_failed")).drop("_failed")
