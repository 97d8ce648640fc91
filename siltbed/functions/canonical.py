"""Canonical text of values, and hashes of records for change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What stands for NULL (two characters) and what parts the values.
NULL_TEXT, SEPARATOR = "\\N", "\x1f"


def quoted(name: str) -> str:
    """An identifier in backticks."""
    return "`" + name.replace("`", "``") + "`"


def canonical(df: DataFrame, name: str) -> Column:
    """One column's text: the same for equal values, NULL told from every text.

    Floats keep Spark's text, exponents included: cast them to DECIMAL before.
    Arrays, maps and structs are JSON.
    """
    c, kind = F.col(quoted(name)), df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    elif isinstance(kind, T.DateType):
        text = F.date_format(c, "yyyy-MM-dd")
    elif isinstance(kind, T.BinaryType):
        text = F.lower(F.hex(c))
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(c)
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(NULL_TEXT))


def record_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of the canonical texts in the given order; of nothing if there are none."""
    return F.sha2(F.concat_ws(SEPARATOR, *[canonical(df, c) for c in columns]), 256)
