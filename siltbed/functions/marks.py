"""High-water marks: canonical text, parsing, and the larger of two."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATETIME, NUMERIC, STRING = "DATETIME", "NUMERIC", "STRING"
#: The least mark of each type, for queries that need a literal.
FLOORS = {DATETIME: "1900-01-01", NUMERIC: "-999999999999999999", STRING: ""}


def mark_text(value: Column, kind: str) -> Column:
    """DATETIME to microseconds, NUMERIC plain and without trailing zeros, STRING as it is."""
    if kind == DATETIME:
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if kind == NUMERIC:
        text = value.cast("decimal(38,10)").cast("string")
        return F.regexp_replace(F.regexp_replace(text, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return value.cast("string")


def parsed_mark(text: Column, kind: str) -> Column:
    """A mark's typed value; empty and unreadable texts are NULL."""
    if kind == DATETIME:
        own = F.replace(text, F.lit("T"), F.lit(" "))
        forms = ("yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
        return F.coalesce(*[F.try_to_timestamp(own, F.lit(f)) for f in forms]).cast("timestamp_ntz")
    if kind == NUMERIC:
        return text.try_cast("decimal(38,10)")
    return F.nullif(text, F.lit(""))


def advanced(before: Column, batch: Column) -> Column:
    """The larger of two typed marks; a NULL never wins, so a mark never goes back."""
    return F.greatest(before, batch)
