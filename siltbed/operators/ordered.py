"""Row numbers, rows before and after, and values carried forward, where one key may have very many rows.

A window sorts all of a key in one task. Here a key with more than `least` rows and
more than a thousandth of all rows (fewer than a thousand keys) is cut into slices by
the order; windows run within slices, and what a slice needs of those before or after it, one
row a slice, is carried to it by a broadcast join. Where no key is hot, which one
count by key tells, the plan is the plain window.

Cuts come from a sample of the hot keys by hash, so they are the same in every run;
results don't depend on them. Rows that are equal in the columns of the cuts stay together:
tie-breaks belong into the order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST = 1_000_000
HOT_SHARE = 1000
#: Slices of a key at most, and sampled rows for each of them.
SLICES, SAMPLED = 256, 32


@dataclass(frozen=True)
class Cuts:
    """The hot keys' ascending cuts: keys and _cuts, an array of structs of the columns `by`; None if none is hot."""

    keys: tuple[str, ...]
    by: tuple[str, ...]
    frame: DataFrame | None


def _same(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys]


def cuts(df: DataFrame, keys: Sequence[str], by: Sequence[str], least: int = LEAST) -> Cuts:
    """Where df's hot keys are cut; one pass over its keys if there are none. Holds for any part of df, too."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    most, total = counts.agg(F.max("_n"), F.sum("_n")).first()
    if not most or most <= least or most * HOT_SHARE <= total:
        return Cuts(tuple(keys), tuple(by), None)
    hot = F.broadcast(counts.where((F.col("_n") > least) & (F.col("_n") * HOT_SHARE > total)))
    slices = F.least(F.ceil(F.col("_n") / least), F.lit(SLICES))
    step = F.greatest(F.ceil(F.col("_n") / (slices * SAMPLED)), F.lit(1)).cast("long")
    own = df.select(*keys, F.struct(*by).alias("_o")).alias("l").join(hot.alias("r"), _same(keys))
    # equal rows are all in the sample or none of them, so they are counted once
    sample = own.where(F.pmod(F.xxhash64("_o"), step) == 0).select(*[F.col(f"l.`{k}`") for k in keys], "_o").distinct()
    at = F.row_number().over(Window.partitionBy(*keys).orderBy("_o"))
    picked = sample.withColumn("_at", at).where(F.col("_at") % SAMPLED == 0)
    return Cuts(tuple(keys), tuple(by), picked.groupBy(*keys).agg(F.sort_array(F.collect_list("_o")).alias("_cuts")))


class Sliced:
    """df with its slices; the windows over them, and what is carried between them."""

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], known: Cuts | None = None, least: int = LEAST):
        self.keys, self.order, self.columns = list(keys), list(order), df.columns
        found = known or cuts(df, keys, order, least)
        self.hot = found.frame is not None
        if self.hot:
            own = df.alias("l").join(F.broadcast(found.frame).alias("r"), _same(keys), "left")
            place = F.size(F.filter("_cuts", lambda c: c <= F.struct(*[F.col(f"l.`{b}`") for b in found.by])))
            df = own.select(*[F.col(f"l.`{c}`") for c in df.columns], F.when(F.col("_cuts").isNotNull(), place).alias("_slice"))
        self.rows = df
        self.window = Window.partitionBy(*keys, *(["_slice"] if self.hot else [])).orderBy(*order)

    def carried(self, rows: DataFrame, ends: Mapping[str, Column], given: Mapping[str, Column]) -> DataFrame:
        """rows with the columns of `given`: made of `ends`, an aggregate of each hot slice, over the slices of a key.

        The columns of `given` are window expressions; `Sliced.across` is their window.
        """
        ends_of = rows.where(F.col("_slice").isNotNull()).groupBy(*self.keys, "_slice").agg(*[c.alias(n) for n, c in ends.items()])
        known = ends_of.select(*self.keys, "_slice", *[c.alias(n) for n, c in given.items()])
        joined = rows.alias("l").join(F.broadcast(known).alias("r"), _same([*self.keys, "_slice"]), "left")
        return joined.select(*[F.col(f"l.`{c}`") for c in rows.columns], *given)

    @property
    def across(self) -> Window:
        return Window.partitionBy(*self.keys).orderBy("_slice")

    def place(self) -> Column:
        """What orders rows within a key."""
        return F.struct(*[F.col(f"`{c}`") for c in self.order])


def _beside(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, str], after: bool, known: Cuts | None, least: int) -> DataFrame:
    s = Sliced(df, keys, order, known, least)
    beside = F.lead if after else F.lag
    if not s.hot:
        return s.rows.withColumns({out: beside(v).over(s.window) for out, v in values.items()})
    picked = F.min_by if after else F.max_by
    packed = F.struct(*[F.col(f"`{v}`").alias(out) for out, v in values.items()])
    rows = s.rows.withColumns({"_own": packed, "_there": F.lit(True)})
    rows = rows.withColumns({"_next": beside("_own").over(s.window), "_inside": beside("_there").over(s.window)}).drop("_there")
    rows = s.carried(rows, {"_end": picked("_own", s.place())}, {"_carried": beside("_end").over(s.across)})
    got = F.when(F.col("_inside"), F.col("_next")).otherwise(F.col("_carried"))
    return rows.withColumn("_got", got).select(*s.columns, *[F.col(f"_got.`{out}`").alias(out) for out in values])


def before(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, str], known: Cuts | None = None, least: int = LEAST) -> DataFrame:
    """df with values (new column: column) of the row before, in the order of a key; NULL of the first."""
    return _beside(df, keys, order, values, False, known, least)


def after(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, str], known: Cuts | None = None, least: int = LEAST) -> DataFrame:
    """df with values (new column: column) of the row after, in the order of a key; NULL of the last."""
    return _beside(df, keys, order, values, True, known, least)


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "position", known: Cuts | None = None, least: int = LEAST) -> DataFrame:
    """df with the place of each row in the order of its key, from 1."""
    s = Sliced(df, keys, order, known, least)
    rows = s.rows.withColumn(out, F.row_number().over(s.window).cast("long"))
    if not s.hot:
        return rows
    rows = s.carried(rows, {"_n": F.count("*")}, {"_before": F.sum("_n").over(s.across.rowsBetween(Window.unboundedPreceding, -1))})
    return rows.select(*s.columns, (F.col(out) + F.coalesce("_before", F.lit(0))).alias(out))


def summed(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, known: Cuts | None = None, least: int = LEAST) -> DataFrame:
    """df with the sum of the values of all rows before each, in the order of a key; 0 of the first. Values are integers."""
    s = Sliced(df, keys, order, known, least)
    so_far = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    rows = s.rows.withColumn(out, F.coalesce(F.sum(value).over(so_far(s.window)), F.lit(0)))
    if not s.hot:
        return rows
    rows = s.carried(rows, {"_n": F.sum(value)}, {"_before": F.sum("_n").over(so_far(s.across))})
    return rows.select(*s.columns, (F.col(out) + F.coalesce("_before", F.lit(0))).alias(out))


def filled(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, known: Cuts | None = None, least: int = LEAST) -> DataFrame:
    """df with the last value that is not NULL up to each row, its own included, in the order of a key."""
    s = Sliced(df, keys, order, known, least)
    so_far = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = s.rows.withColumn(out, F.last(value, ignorenulls=True).over(so_far(s.window)))
    if not s.hot:
        return rows
    last = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), s.place()))
    rows = s.carried(rows, {"_end": last}, {"_carried": F.last("_end", ignorenulls=True).over(s.across.rowsBetween(Window.unboundedPreceding, -1))})
    return rows.select(*s.columns, F.coalesce(out, "_carried").alias(out))


def pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], most: int = 1000, known: Cuts | None = None, least: int = LEAST, limit: int | None = None) -> DataFrame:
    """Each key's values in order, `most` rows at most in a piece: keys, piece (from 0), rows (an array of structs of values).

    A piece, not a key, is what one task gathers. limit: a key with more rows than that is an error.
    """
    rows = numbered(df.select(*dict.fromkeys([*keys, *order, *values])), keys, order, "_at", known, least)
    if limit is not None:
        said = F.concat(F.lit(f"a list of more than {limit} rows: "), F.to_json(F.struct(*keys)))
        rows = rows.withColumn("_at", F.when(F.col("_at") > limit, F.raise_error(said).cast("long")).otherwise(F.col("_at")))
    piece = F.floor((F.col("_at") - 1) / most).cast("long").alias("piece")
    inside = F.sort_array(F.collect_list(F.struct("_at", F.struct(*values).alias("v"))))
    return rows.groupBy(*keys, piece).agg(F.transform(inside, lambda x: x["v"]).alias("rows"))


#: Rows of a list that is one value.
LISTED = 1_000_000


def listed(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], limit: int = LISTED) -> DataFrame:
    """Each key's values in order as one array, `rows`: for keys whose lists are a value's size.

    The pieces of a list are put together; a key of more than `limit` rows is an error before that: use pieces().
    """
    parts = pieces(df, keys, order, values, limit=limit)
    inside = F.sort_array(F.collect_list(F.struct("piece", "rows")))
    return parts.groupBy(*keys).agg(F.flatten(F.transform(inside, lambda x: x["rows"])).alias("rows"))
