"""Projection by metadata, technical columns, additive schema changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions.canonical import quoted

#: Columns that every loaded table has, and those of versioned tables.
TECHNICAL = {
    "bronze_run_id": "string", "bronze_entity_run_id": "string", "bronze_created_datetime": "timestamp", "bronze_updated_datetime": "timestamp",
    "bronze_ingestion_datetime": "timestamp", "bronze_source_system": "string", "bronze_source_table": "string", "bronze_record_hash": "string", "bronze_record_status": "string",
}
VERSIONED = {"bronze_valid_from": "timestamp", "bronze_valid_to": "timestamp", "bronze_is_current": "boolean"}
ACTIVE, DELETED = "ACTIVE", "DELETED"


@dataclass(frozen=True)
class ColumnSpec:
    """A target column: where it comes from, its type, and what it is for."""

    source: str
    target: str
    type: str
    key: bool = False
    mark: bool = False
    hashed: bool = True
    mapping: str | None = None


def missing_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Names that df lacks, whatever their case."""
    have = {c.lower() for c in df.columns}
    return [n for n in names if n.lower() not in have]


def projections(df: DataFrame, columns: Sequence[ColumnSpec]) -> list[Column]:
    """The columns of project()."""
    have = {c.lower(): c for c in df.columns}
    out = []
    for c in columns:
        if c.mapping:
            value = F.expr(c.mapping)
        elif c.source.lower() in have:
            value = F.col(quoted(have[c.source.lower()]))
        else:
            value = F.lit(None)
        out.append(value.try_cast(c.type).alias(c.target))
    return out


def project(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Renames, maps and types each column once; what can't be converted is NULL."""
    return df.select(*projections(df, columns))


def with_technical(df: DataFrame, run_id: str, entity_run_id: str, now: str, source_system: str, source_table: str) -> DataFrame:
    """Adds the technical columns but the hash, as literals; now is the run's UTC time."""
    at = F.lit(now).cast("timestamp")
    values = {"bronze_run_id": F.lit(run_id), "bronze_entity_run_id": F.lit(entity_run_id), "bronze_created_datetime": at, "bronze_updated_datetime": at, "bronze_ingestion_datetime": at, "bronze_source_system": F.lit(source_system), "bronze_source_table": F.lit(source_table), "bronze_record_status": F.lit(ACTIVE)}
    return df.withColumns(values)


def table_schema(columns: Sequence[ColumnSpec], versioned: bool = False) -> T.StructType:
    """Business, technical and, if versioned, interval columns."""
    extra = TECHNICAL | (VERSIONED if versioned else {})
    return T.StructType.fromDDL(", ".join([*(f"{quoted(c.target)} {c.type}" for c in columns), *(f"{n} {t}" for n, t in extra.items())]))


def evolve(df: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """Adds wanted columns (name to type) that df lacks, as NULL; nothing is dropped or retyped."""
    lacking = missing_columns(df, list(wanted))
    return df.withColumns({n: F.lit(None).cast(wanted[n]) for n in lacking}) if lacking else df
