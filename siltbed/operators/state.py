"""High-water marks of many entities: batch maxima, advances, guarded commits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batch_max(df: DataFrame, mark: str, by: Sequence[str] = ()) -> DataFrame:
    """batch_mark (of each group): the largest mark, NULL for no rows."""
    return df.groupBy(*by).agg(F.max(mark).alias("batch_mark"))


def commit(state: DataFrame, proposals: DataFrame) -> DataFrame:
    """Compare and set: proposals (entity, expected, proposed) against state (entity, mark).

    outcome: inserted (no state), noop (nothing new), committed (state is what was
    expected), conflict (it is not; the mark stays). Marks are canonical texts.
    """
    s = state.select(F.col("entity").alias("_e"), F.col("mark").alias("_m"), F.lit(True).alias("_there"))
    out = proposals.join(s, F.col("entity") == F.col("_e"), "full_outer")
    outcome = (
        F.when(F.col("entity").isNull(), "untouched")
        .when(F.col("_there").isNull(), "inserted")
        .when(F.col("proposed").isNull() | F.col("proposed").eqNullSafe(F.col("_m")), "noop")
        .when(F.col("_m").eqNullSafe(F.col("expected")), "committed")
        .otherwise("conflict")
    )
    out = out.withColumn("outcome", outcome)
    mark = F.when(F.col("outcome").isin("inserted", "committed"), F.col("proposed")).otherwise(F.col("_m"))
    return out.select(F.coalesce("entity", "_e").alias("entity"), mark.alias("mark"), "outcome")
