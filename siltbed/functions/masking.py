"""Anonymisation rules as expressions. NULL stays NULL; the column keeps its type."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions.canonical import quoted

KINDS = ("HASH", "MASK", "REDACT", "TOKENIZE", "NULLIFY", "CUSTOM")


@dataclass(frozen=True)
class MaskRule:
    """rule_type HASH, MASK, REDACT, TOKENIZE, NULLIFY or CUSTOM; algorithm EMAIL refines HASH."""

    rule_type: str
    algorithm: str | None = None
    parameters: Mapping[str, object] = field(default_factory=dict)


def masked(df: DataFrame, name: str, rule: MaskRule, salt: str = "") -> Column:
    """The column under a rule; ValueError where the rule can't be applied."""
    c, kind, p = F.col(quoted(name)), df.schema[name].dataType, dict(rule.parameters)
    text, what = c.cast("string"), rule.rule_type.upper()
    digest = F.sha2(F.concat(F.lit(salt), text), 256)
    if what == "NULLIFY":
        return F.lit(None).cast(kind)
    if what == "CUSTOM":
        expression = str(p.get("expression") or "")
        if "{col}" not in expression:
            raise ValueError("a CUSTOM rule needs an expression that holds {col}")
        out = F.expr(expression.replace("{col}", quoted(name)))
    elif not isinstance(kind, T.StringType):
        raise ValueError(f"{what} gives text, but {name} is {kind.simpleString()}")
    elif what == "HASH":
        out = digest
        if (rule.algorithm or "").upper() == "EMAIL":
            out = F.concat(F.substring(digest, 1, int(p.get("length", 16))), F.lit("@" + str(p.get("domain", "example.invalid"))))
    elif what == "MASK":
        keep, sign = int(p.get("keep_last", 4)), str(p.get("mask_char", "*"))[:1] or "*"
        # a text not longer than what is kept becomes empty, never itself
        hidden = F.repeat(F.lit(sign), F.greatest(F.length(text) - keep, F.lit(0)))
        out = F.when(F.length(text) > keep, F.concat(hidden, F.right(text, F.lit(keep)))).otherwise("") if keep else F.repeat(F.lit(sign), F.length(text))
    elif what == "REDACT":
        out = F.lit(str(p.get("replacement", "REDACTED")))
    elif what == "TOKENIZE":
        out = F.concat(F.lit(str(p.get("prefix", "TKN_"))), F.substring(digest, 1, int(p.get("length", 12))))
    else:
        raise ValueError(f"unknown rule type {rule.rule_type!r}")
    return F.when(c.isNotNull(), out.try_cast(kind))


def anonymise(df: DataFrame, rules: Mapping[str, MaskRule], salts: Mapping[str, str] | None = None, enabled: bool = True) -> DataFrame:
    """df with all rules applied in one projection; unchanged unless enabled."""
    if not enabled or not rules:
        return df
    salts = salts or {}
    return df.withColumns({name: masked(df, name, rule, salts.get(name, "")) for name, rule in rules.items()})
