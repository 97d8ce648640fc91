"""Lookups, change feeds and dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.operators import ordered
from siltbed.operators.dedup import top_per_key


def looked_up(df: DataFrame, reference: DataFrame, on: Mapping[str, str], value: str, default: Column, out: str) -> DataFrame:
    """df with the reference's value, or the default; on: column of df to column of the reference.

    What a mandatory lookup misses is told by `lookup_misses`.
    """
    ref = reference.select(*[F.col(r).alias(f"_r{i}") for i, r in enumerate(on.values())], F.col(value).alias("_value"))
    joined = df.join(ref, [F.col(c) == F.col(f"_r{i}") for i, c in enumerate(on)], "left")
    return joined.select(*df.columns, F.coalesce("_value", default).alias(out))


def lookup_misses(df: DataFrame, reference: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows of df that a mandatory lookup finds nothing for; a NULL key finds nothing."""
    ref = reference.select(*[F.col(r).alias(f"_r{i}") for i, r in enumerate(on.values())]).distinct()
    return df.join(ref, [F.col(c) == F.col(f"_r{i}") for i, c in enumerate(on)], "left_anti")


def overwritten(dimension: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A dimension without history (type 1): the batch's rows replace those of their keys, others stay."""
    d, b = dimension.alias("d"), batch.withColumn("_new", F.lit(True)).alias("b")
    joined = d.join(b, [F.col(f"d.{k}") == F.col(f"b.{k}") for k in keys], "full_outer")
    return joined.select(*[F.when(F.col("_new"), F.col(f"b.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in dimension.columns])


def fact_aggregate(facts: DataFrame, by: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Facts by their dimensions' keys, with n_facts and the measures, aggregates by name."""
    return facts.groupBy(*by).agg(F.count("*").alias("n_facts"), *[c.alias(n) for n, c in measures.items()])


def apply_changes(target: DataFrame, feed: DataFrame, keys: Sequence[str], operation: str, order: Sequence[str]) -> DataFrame:
    """target after a feed of INSERT, UPDATE and DELETE rows; the last operation of a key counts."""
    last = top_per_key(feed, keys, [F.col(c).desc() for c in order])
    kept = target.join(last.select(*keys), list(keys), "left_anti")
    return kept.unionByName(last.where(F.col(operation) != "DELETE").select(*target.columns))


def as_of_join(facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, since: str, until: str, least: int = ordered.LEAST) -> DataFrame:
    """Each fact with the version of its key that is valid at its time; facts without one stay.

    Versions of a key do not overlap. Facts and versions are sorted together and the last
    version is carried forward, so a fact meets one version, however many its key has;
    keys with very many rows are cut by time. NULL keys and times match nothing.
    """
    kept = [c for c in versions.columns if c not in keys]
    f = facts.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.col(f"`{at}`").alias("_at"), F.struct(*facts.columns).alias("_fact"), F.lit(None).alias("_version"))
    v = versions.where(F.col(since).isNotNull()).select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.col(f"`{since}`").alias("_at"), F.lit(None).alias("_fact"), F.struct(*kept).alias("_version"))
    own = [f"_k{i}" for i in range(len(keys))]
    # versions come before the facts of their instant; of versions of one instant an empty one first
    rows = f.unionByName(v).withColumns({"_is_fact": F.col("_fact").isNotNull(), "_end": F.coalesce(F.col(f"_version.`{until}`") > F.col("_at"), F.lit(True))})
    found = ordered.filled(rows, own, ["_at", "_is_fact", "_end"], "_version", "_found", ordered.cuts(rows, own, ["_at"], least)).where("_is_fact")
    end, no = F.col(f"_found.`{until}`"), F.lit(False)
    for k in own:
        no = no | F.col(k).isNull()
    valid = ~no & F.col("_at").isNotNull() & (end.isNull() | (F.col("_at") < end))
    return found.select("_fact.*", *[F.when(valid, F.col(f"_found.`{c}`")).alias(c) for c in kept])


def surrogate_key(*columns: str) -> Column:
    """A key from a digest of the natural key: the same in every run, without a global order."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]), 256)


def standardised(df: DataFrame, renames: Mapping[str, str] | None = None, casts: Mapping[str, str] | None = None, trims: Sequence[str] = (), empty_as_null: Sequence[str] = (), defaults: Mapping[str, object] | None = None, derived: Mapping[str, str] | None = None, keys: Sequence[str] = (), order: Sequence[Column] = ()) -> DataFrame:
    """Columns renamed, cast (NULL if impossible), cleansed and derived, in this order, then one row a key:
    the first by `order`. Names after renaming count; projections only, but for the keys' grouping."""
    out = df.withColumnsRenamed(dict(renames or {}))
    out = out.withColumns({n: F.col(n).try_cast(t) for n, t in (casts or {}).items()})
    out = cleansed(out, trims, empty_as_null, defaults)
    out = out.withColumns({n: F.expr(e) for n, e in (derived or {}).items()})
    return top_per_key(out, keys, list(order)) if keys else out


def cleansed(df: DataFrame, trims: Sequence[str] = (), empty_as_null: Sequence[str] = (), defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Texts trimmed, empty ones NULL, NULLs by default values: one projection."""
    names = dict.fromkeys([*trims, *empty_as_null, *(defaults or {})])
    out = {}
    for n in names:
        c = F.col(n)
        if n in trims:
            c = F.trim(c)
        if n in empty_as_null:
            c = F.nullif(c, F.lit(""))
        if defaults and n in defaults:
            c = F.coalesce(c, F.lit(defaults[n]))
        out[n] = c
    return df.withColumns(out)
