"""Constraint checks: each gives the rows that break it, none if all is well."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str], active: Column | None = None) -> DataFrame:
    """Children whose key is set and has no (active) parent; on: child column to parent column."""
    parents = (parent.where(active) if active is not None else parent).select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(on.values())])
    own = child.where(F.coalesce(*[F.col(c).cast("string") for c in on]).isNotNull())
    return own.join(parents, [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(on)], "left_anti")


def childless(parent: DataFrame, child: DataFrame, on: Mapping[str, str], where: Column | None = None) -> DataFrame:
    """Parents without a child (that meets the condition); on: parent column to child column."""
    children = (child.where(where) if where is not None else child).select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(on.values())])
    return parent.join(children, [F.col(p) == F.col(f"_c{i}") for i, p in enumerate(on)], "left_anti")


def blank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a required column NULL or of spaces only, and which: column_name."""
    empty = [F.when(F.col(c).isNull() | (F.trim(F.col(c)) == ""), F.lit(c)) for c in columns]
    return df.withColumn("column_name", F.explode(F.array_compact(F.array(*empty))))


def list_strangers(df: DataFrame, column: str, separator: str, reference: DataFrame, name: str) -> DataFrame:
    """Members of a separated list (trimmed) that the reference lacks, as `member`."""
    members = df.withColumn("member", F.explode(F.split(F.col(column), separator))).withColumn("member", F.trim("member"))
    return members.where("member <> ''").join(reference.select(F.col(name).alias("_m")).distinct(), F.col("member") == F.col("_m"), "left_anti")


def flag_disagrees(df: DataFrame, flag: Column, column: str, separator: str, member: Column) -> DataFrame:
    """Rows whose flag is not whether the list has the member."""
    has = F.array_contains(F.transform(F.split(F.col(column), separator), F.trim), member)
    return df.where(~flag.eqNullSafe(has))


def undefined(df: DataFrame, kind: str, allowed: Sequence[str], definitions: DataFrame, key: str) -> DataFrame:
    """Rows of a kind that is not allowed, or without a definition."""
    defined = definitions.select(F.col(key).alias("_d")).distinct()
    out = df.join(defined, F.col(key) == F.col("_d"), "left")
    return out.where(~F.col(kind).isin(*allowed) | F.col("_d").isNull()).drop("_d")


def breaking(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which a rule does not hold; NULL is no break."""
    return df.where(~rule)


def derived_flag(parent: DataFrame, child: DataFrame, on: Mapping[str, str], flag: Column, derived: Column) -> DataFrame:
    """Parents whose flag is not the largest derived flag of their children, as derived_flag; false without any."""
    (p, c), = on.items()
    most = child.groupBy(F.col(c).alias("_c")).agg(F.max(derived).alias("derived_flag"))
    out = parent.join(most, F.col(p) == F.col("_c"), "left").drop("_c").withColumn("derived_flag", F.coalesce("derived_flag", F.lit(False)))
    return out.where(flag != F.col("derived_flag"))


def not_in(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return df.where(~F.coalesce(F.col(column).isin(*allowed), F.lit(False)))


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of more than one row, with n."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def grid_gaps(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs of a value of a and a value of b that never occur together.

    The grid is the product of two sets of names (environments, settings, groups),
    both distinct; it is the answer's own size, not that of the rows.
    """
    grid = rows.select(a).distinct().crossJoin(rows.select(b).distinct())
    return grid.join(rows.select(a, b).distinct(), [a, b], "left_anti")


def visible_rows(df: DataFrame, access: DataFrame, user: str, on: Mapping[str, str]) -> DataFrame:
    """Rows that an active access row of the user opens; a NULL key opens all.

    on: row column to access column. Access rows are grouped by which of their keys
    are NULL; each pattern that occurs (2 to the number of keys at most) is an equality
    join, and the rows are read once for all of them.
    """
    names = list(on)
    own = access.where((F.col("user_name") == user) & F.col("is_active")).select(*[F.col(a).alias(f"_a{i}") for i, a in enumerate(on.values())]).distinct()
    pattern = F.concat(*[F.when(F.col(f"_a{i}").isNull(), "0").otherwise("1") for i in range(len(names))])
    found = sorted(r[0] for r in own.select(pattern).distinct().collect())
    if "0" * len(names) in found:
        return df
    opened, out = F.lit(False), df
    for n, bits in enumerate(found):
        used = [i for i, b in enumerate(bits) if b == "1"]
        side = own.where(pattern == bits).select(*[F.col(f"_a{i}").alias(f"_p{n}_{i}") for i in used], F.lit(True).alias(f"_open{n}"))
        out = out.join(side, [F.col(names[i]) == F.col(f"_p{n}_{i}") for i in used], "left")
        opened = opened | F.col(f"_open{n}").isNotNull()
    return out.where(opened).select(*df.columns)
