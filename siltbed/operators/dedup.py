"""Exact duplicates, latest rows, top rows, and how many rows go."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(columns) if columns else df.columns)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key; Spark cuts groups to n before the shuffle already."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], mark: str | None, sequence: Sequence[str] = ()) -> DataFrame:
    """The row of each key with the largest mark, NULL last; ties go by the sequence
    columns, largest first, and then by all columns, so that results do not depend on layout."""
    rest = [c for c in df.columns if c not in (*keys, mark, *sequence)]
    order = [F.col(mark).desc_nulls_last()] if mark else []
    return top_per_key(df, keys, [*order, *[F.col(c).desc_nulls_last() for c in [*sequence, *rest]]])


def deduplicate(df: DataFrame, keys: Sequence[str], mark: str | None, versioned: bool, sequence: Sequence[str] = ()) -> DataFrame:
    """Versioned tables and tables without a key lose equal rows only; others keep the latest of each key."""
    return exact(df) if versioned or not keys else latest_per_key(df, keys, mark, sequence)


def surplus(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: surplus_rows, the rows beyond the first of each key; NULL is a key like any other."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("surplus_rows"))
