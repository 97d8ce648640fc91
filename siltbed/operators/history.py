"""Versioned targets: intervals of validity for each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.operators import ordered
from siltbed.operators.ordered import Cuts
from siltbed.operators.touched import KeyFilter

HASH, FROM, TO, CURRENT, UPDATED = "bronze_record_hash", "bronze_valid_from", "bronze_valid_to", "bronze_is_current", "bronze_updated_datetime"


def candidates(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch that may become versions, with the current hash as `_seed`.

    Kept are keys without a current version, later rows, and rows of the same
    instant and another hash; rows that are a version already go, so that a run
    can be repeated.
    """
    now = target.where(CURRENT).select(*keys, F.col(HASH).alias("_seed"), F.col(FROM).alias("_since"))
    later = F.col("_since").isNull() | (F.col(FROM) > F.col("_since")) | ((F.col(FROM) == F.col("_since")) & (F.col(HASH) != F.col("_seed")))
    # what passes that test and is a version already began with the current one and ended
    # at once, or is undated. The key deals the rows out, as in the join before
    known = target.where(F.col(FROM).eqNullSafe(F.col(TO)) | F.col(FROM).isNull()).select(*keys, F.col(FROM).alias("_from"), F.col(HASH).alias("_hash"))
    out = batch.join(now, list(keys), "left").where(later)
    same = [F.col(f"b.{k}") == F.col(f"k.{k}") for k in keys]
    again = [F.col(f"b.{FROM}").eqNullSafe(F.col("_from")), F.col(f"b.{HASH}").eqNullSafe(F.col("_hash"))]
    return out.alias("b").join(known.alias("k"), [*same, *again], "left_anti").drop("_since")


def collapse(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = HASH, seed: str | None = None, known: Cuts | None = None) -> DataFrame:
    """Rows whose value differs from that of the row before; the seed comes before the first.

    known: the cuts of hot keys, if the caller has them."""
    rows = ordered.before(df, keys, order, {"_before": value}, known)
    last = F.coalesce("_before", seed) if seed else F.col("_before")
    return rows.where(last.isNull() | (last != F.col(value))).drop("_before")


def intervals(df: DataFrame, keys: Sequence[str], order: Sequence[str], since: str = FROM, until: str = TO, current: str = CURRENT, known: Cuts | None = None) -> DataFrame:
    """Each row is valid until the next one begins; the last is current."""
    rows = ordered.after(df.drop(until, current), keys, order, {until: since}, known)
    return rows.withColumn(current, F.col(until).isNull())


def versions(batch: DataFrame, target: DataFrame, keys: Sequence[str], sequence: Sequence[str] = (), known: Cuts | None = None) -> DataFrame:
    """New versions that the batch brings. Ties of an instant go by sequence, then hash."""
    order = [FROM, *sequence, HASH]
    known = known or ordered.cuts(batch, keys, [FROM])
    rows = collapse(candidates(batch, target, keys), keys, order, seed="_seed", known=known).drop("_seed")
    return intervals(rows, keys, order, known=known)


def _closed(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """target with current versions closed where new ones begin, and `_closing`."""
    touched = UPDATED in target.columns and UPDATED in new.columns
    closes = new.groupBy(*keys).agg(F.min(FROM).alias("_close"), *([F.max(UPDATED).alias("_touched")] if touched else []))
    closing = F.col(CURRENT) & F.col("_close").isNotNull()
    values = {TO: F.when(F.col("_closing"), F.col("_close")).otherwise(F.col(TO)), CURRENT: F.when(F.col("_closing"), False).otherwise(F.col(CURRENT))}
    if touched:
        values[UPDATED] = F.when(F.col("_closing"), F.col("_touched")).otherwise(F.col(UPDATED))
    joined = target.join(closes, list(keys), "left").withColumn("_closing", F.coalesce(closing, F.lit(False)))
    return joined.withColumns(values).select(*target.columns, "_closing")


def apply(target: DataFrame, batch: DataFrame, keys: Sequence[str], sequence: Sequence[str] = ()) -> DataFrame:
    """target with its current versions closed where new ones begin, and the new ones."""
    new = versions(batch, target, keys, sequence)
    old = _closed(target, new, keys).drop("_closing")
    return old.unionByName(new.select(*[c for c in target.columns if c in new.columns]), allowMissingColumns=True)


#: States of versions: what a load may close, what it must know of, and what it never reads again.
STATE, NOW, INSTANT, PAST = "state", "current", "instant", "closed"


def state() -> Column:
    """A version's state: current; instant, closed but undated or ended as it began; or closed."""
    return F.when(F.col(CURRENT), NOW).when(F.col(FROM).isNull() | F.col(FROM).eqNullSafe(F.col(TO)), INSTANT).otherwise(PAST)


def advance(current: DataFrame, instants: DataFrame, batch: DataFrame, keys: Sequence[str], sequence: Sequence[str] = (), touched: KeyFilter | None = None, known: Cuts | None = None) -> DataFrame:
    """What a batch makes of the current versions, with `state` and `_action`: current versions that stay
    (KEEP) or are closed (UPDATE), and new versions (INSERT), which may be closed at once.

    Closed versions are not asked for; instants are the closed ones that a repeated batch could
    bring again. touched: a filter of the batch's keys, past which only its current versions are joined.
    """
    may, rest = touched.part(current) if touched else (current, None)
    some = touched.part(instants)[0] if touched else instants
    new = versions(batch, may.unionByName(some), keys, sequence, known)
    old = _closed(may, new, keys)
    old = old.withColumn("_action", F.when(F.col("_closing"), "UPDATE").otherwise("KEEP")).drop("_closing")
    fresh = new.select(*[c for c in current.columns if c in new.columns]).withColumn("_action", F.lit("INSERT"))
    out = old.unionByName(fresh, allowMissingColumns=True)
    if rest is not None:
        out = out.unionByName(rest.withColumn("_action", F.lit("KEEP")))
    return out.withColumn(STATE, state())
