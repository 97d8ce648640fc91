"""Applying a batch to a target without a transactional table format.

Functions take target and batch and give the new target, so a caller may write it
as a new snapshot. A merge is one full outer join on the key; what a row became
is in `_action`. With a filter of the batch's keys, rows of the target that can't match
stay out of the join, so that what is exchanged follows the batch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.functions.canonical import quoted
from siltbed.operators.shape import ACTIVE, DELETED
from siltbed.operators.touched import KeyFilter

HASH, STATUS, CREATED, UPDATED = "bronze_record_hash", "bronze_record_status", "bronze_created_datetime", "bronze_updated_datetime"
RUN_COLUMNS = ("bronze_run_id", "bronze_entity_run_id")


def changed(new: str = "s", old: str = "t") -> Column:
    """Whether a matched row is to be updated: another hash, no hash, or not active."""
    old_hash = F.col(f"{old}.{HASH}")
    return old_hash.isNull() | (old_hash != F.col(f"{new}.{HASH}")) | ~F.col(f"{old}.{STATUS}").eqNullSafe(ACTIVE)


def merge(target: DataFrame, batch: DataFrame, keys: Sequence[str], full_load: bool = False, soft_delete: bool = False, detect: bool = True, stamp: Mapping[str, object] | None = None, touched: KeyFilter | None = None, told: bool = False) -> DataFrame:
    """target after the batch, and `_action` of each row: INSERT, UPDATE, DELETE or KEEP.

    Updates take every column of the batch but the time of creation; columns that
    the batch lacks keep their values. Keys that a full load lacks are marked
    DELETED if soft_delete, and get the batch's run and time: `stamp`, or the largest
    in the batch if it is not given (one more pass over it). NULL keys match nothing:
    check them before. touched: a filter of the batch's keys; not used where keys that the batch
    lacks change. told: SAME instead of KEEP for rows that the batch has as they are.
    """
    if touched is not None and not (full_load and soft_delete):
        may, rest = touched.part(target)
        return merge(may, batch, keys, full_load, False, detect, told=told).unionByName(rest.withColumn("_action", F.lit("KEEP")))
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = batch.withColumn("_in_batch", F.lit(True)).alias("s")
    same = [F.col(f"t.{quoted(k)}") == F.col(f"s.{quoted(k)}") for k in keys]
    joined = t.join(s, same, "full_outer")
    there, here = F.col("t._in_target").isNotNull(), F.col("s._in_batch").isNotNull()
    gone = there & ~here & (F.col(f"t.{STATUS}") == ACTIVE) if full_load and soft_delete else F.lit(False)
    action = F.when(~there, "INSERT").when(here & (changed() if detect else F.lit(True)), "UPDATE").when(gone, "DELETE").when(here & F.lit(told), "SAME").otherwise("KEEP")
    batch_columns = {c.lower() for c in batch.columns}
    runs = [c for c in (*RUN_COLUMNS, UPDATED) if c in batch.columns] if full_load and soft_delete else []

    def value(name: str) -> Column:
        old = F.col(f"t.{quoted(name)}")
        if name.lower() not in batch_columns:
            return old
        new = F.col(f"s.{quoted(name)}")
        out = F.when(F.col("_action") == "INSERT", new)
        if name != CREATED:
            out = out.when(F.col("_action") == "UPDATE", new)
        if name == STATUS:
            out = out.when(F.col("_action") == "DELETE", F.lit(DELETED))
        if name in runs:
            given = F.col(f"r.{name}") if stamp is None else F.lit(stamp[name]).cast(target.schema[name].dataType)
            out = out.when(F.col("_action") == "DELETE", given)
        return out.otherwise(old)

    joined = joined.withColumn("_action", action)
    if runs and stamp is None:
        joined = joined.join(F.broadcast(batch.select(*[F.max(c).alias(c) for c in runs]).alias("r")))  # one row
    return joined.select(*[value(c).alias(c) for c in target.columns], "_action")


def classify(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys and change: new, changed, unchanged or missing."""
    t = target.select(*keys, HASH).withColumn("_in_target", F.lit(True)).alias("t")
    s = batch.select(*keys, HASH).withColumn("_in_batch", F.lit(True)).alias("s")
    joined = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    change = F.when(F.col("_in_target").isNull(), "new").when(F.col("_in_batch").isNull(), "missing").when(F.col(f"t.{HASH}").eqNullSafe(F.col(f"s.{HASH}")), "unchanged").otherwise("changed")
    return joined.select(*[F.coalesce(F.col(f"t.{k}"), F.col(f"s.{k}")).alias(k) for k in keys], change.alias("change"))


def metrics(merged: DataFrame) -> DataFrame:
    """One row: inserted, updated, deleted; soft deletes are no updates."""
    return merged.agg(*counts())


def counts() -> list[Column]:
    """Aggregates of `_action`, for metrics or an Observation: inserted, updated, deleted."""
    return [F.count_if(F.col("_action") == a).alias(n) for a, n in (("INSERT", "inserted"), ("UPDATE", "updated"), ("DELETE", "deleted"))]


def append(target: DataFrame, batch: DataFrame, entity_run_id: str) -> DataFrame:
    """target with this run's rows replaced by the batch: repeating a run changes nothing."""
    return target.where(~F.col("bronze_entity_run_id").eqNullSafe(F.lit(entity_run_id))).unionByName(batch, allowMissingColumns=True)


def replace(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The batch in the target's columns and order."""
    have = {c.lower(): c for c in batch.columns}
    return batch.select(*[(F.col(quoted(have[f.name.lower()])) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema])
