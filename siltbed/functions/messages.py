"""Log messages: scrubbing of personal values, and whether an error is worth a retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What is scrubbed, in this order; Unicode classes.
QUOTED = "'[^']{3,}'"
EMAIL = r"(?U)[\w.+-]+@[\w-]+\.[\w.-]+"
LONG_DIGITS = r"(?U)\b\d{7,}\b"
LONGEST = 4000
#: Error numbers and states of dropped connections, throttling and failover.
TRANSIENT_NUMBERS = ("40613", "40197", "40501", "49918", "49919", "49920", "10928", "10929", "10053", "10054", "10060", "233", "64", "4060", "4221", "1205")
TRANSIENT_STATES = ("08S01", "08001", "HYT00", "HYT01", "40001")
#: Texts of errors that pass, and of errors that stay.
TRANSIENT = r"(?i)timed? ?out|timeout|connection (reset|refused|closed|was forcibly)|temporar(y|ily)|transient|too many requests|\b429\b|\b503\b|service unavailable|throttl|capacity|ConcurrentAppendException|ConcurrentModificationException|ConcurrentDeleteReadException|gateway (timeout|is unreachable)|socket"
LASTING = r"(?i)UNRESOLVED_COLUMN|cannot resolve|DATATYPE_MISMATCH|CAST_INVALID_INPUT|PARSE_SYNTAX_ERROR|schema mismatch|A schema mismatch detected|TABLE_OR_VIEW_NOT_FOUND|Invalid column name|Invalid object name|Incorrect syntax|permission|not authorized|Login failed"


def scrubbed(message: Column) -> Column:
    """Quoted texts, then e-mail addresses, then long digit runs give way; cut to LONGEST."""
    out = F.regexp_replace(message, QUOTED, "'<redacted>'")
    out = F.regexp_replace(out, EMAIL, "<redacted-email>")
    return F.substring(F.regexp_replace(out, LONG_DIGITS, "<redacted-number>"), 1, LONGEST)


def is_retryable(code: Column, message: Column) -> Column:
    """By the code (state, or state:number), then by the text; in doubt not."""
    state, number = F.split_part(code, F.lit(":"), F.lit(1)), F.split_part(code, F.lit(":"), F.lit(2))
    known = F.coalesce(number.isin(*TRANSIENT_NUMBERS) | state.isin(*TRANSIENT_STATES), F.lit(False))
    text = F.coalesce(message, F.lit(""))
    return F.when(known, True).when(text.rlike(LASTING), False).otherwise(text.rlike(TRANSIENT))


def error_code(message: Column) -> Column:
    """The five-letter state that a message begins with, and the number in brackets after it."""
    state = F.regexp_extract(message, r"^([0-9A-Z]{5})\b", 1)
    number = F.regexp_extract(message, r"\((\d{2,6})\)", 1)
    return F.when(state == "", None).when(number == "", state).otherwise(F.concat_ws(":", state, number))
