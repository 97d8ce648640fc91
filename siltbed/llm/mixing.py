"""Mixing sources to target weights: native DataFrame operations only.

Sizes are words. Each source gets a target in words: `share` times all sizes,
dealt by weight, no source above `most` times its own size; what a source can't
take is dealt to the others again. Targets are the fixed point min(most * size,
level * weight): a source table of one row each is summed once a round, and the
level, one number, is all that the driver holds.

A source takes its documents in complete epochs first. The rest of its target is
an Efraimidis-Spirakis sample: document i has the key -ln(u)/w, u from a digest
of its id and text and w its quality weight; documents are taken by rising key
until the words taken reach the rest; the last one is taken in part. A quality
column of the caller's may replace the default weight. The prefix sums never
gather a source in one task: keys are cut into 4096 buckets by their distribution
function, bucket sums are added up, and the one bucket of each source in which
its rest ends is cut again in the same way until it has LAST_ROWS at most (or
its rows can't be told apart); only that is sorted row by row. A task sees 4096
sums of a source, whatever its size and however its keys lie.

Defined results: null texts count as empty and take nothing; sources are ordered
by code point, null last; repeated rows share a key and are taken as if they
were different documents; a quality that is null or NaN counts as 1, one of 0 or
less is taken last; columns of the caller named like an added one give way, all
other names are free; very long texts are counted whole; reruns agree; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm.common import stored

#: What a word is; weights of the sources in order, repeating.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
LEVEL_BITS, LEVELS, LAST_ROWS = 12, 4, 1000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column, size: Column) -> Column:
    """From 1 to 4: how near the mean word length is to that of prose, by code points."""
    mean = F.coalesce(F.length(text), F.lit(0)) / F.greatest(size, F.lit(1))
    return 1 + 3 * (1 - F.least(F.lit(1.0), F.abs(mean - 6) / 6))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, quality_col: str | None, seed: int) -> DataFrame:
    """docs and _src (null last in order), _size, _key, _place; the last two from a digest.

    _place is the key's distribution function at quality 1, in 48 bits.
    """
    text = F.col(f"`{text_col}`")
    digest = F.sha2(F.concat_ws("\x1f", F.lit(str(seed)), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.coalesce(text, F.lit(""))), 256)
    rows = docs.withColumn("_size", words(text))
    # 52 bits, never 0
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    given = None if quality_col is None else F.col(f"`{quality_col}`").cast("double")
    w = quality(text, F.col("_size")) if given is None else F.when(given.isNull() | F.isnan(given), 1.0).otherwise(given)
    rows = rows.withColumn("_key", F.when(w > 0, -F.log(u) / w).otherwise(F.lit(float("inf"))))
    src = F.when(F.col(f"`{source_col}`").isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), F.col(f"`{source_col}`").cast("string")))
    most = 1 << (LEVEL_BITS * LEVELS)
    place = F.least(F.floor((1 - F.exp(-F.col("_key"))) * F.lit(float(most))), F.lit(most - 1)).cast("long")
    return rows.withColumns({"_src": src, "_place": place})


def weighted(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds _weight, the weights repeating over the sources in order.

    Places are counted in two steps: within ranges of names, and over the ranges.
    """
    spark = sources.sparkSession
    parts = stored(sources.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "_src").withColumn("_part", F.spark_partition_id()), "mix-ranges")
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy("_src")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    return parts.join(before, "_part").withColumn("_weight", weight.cast("double")).drop("_part", "_before")


def targets(sources: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds target to (source_size, _weight): dealt by weight, capped, the excess dealt again."""
    cap, weight = F.col("source_size") * F.lit(most), F.col("_weight")
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        full = cap < F.lit(level) * weight
        row = sources.agg(F.count_if(full), F.sum(F.when(full, cap)), F.sum(F.when(~full, weight))).first()
        if row[0] == capped or not row[2]:
            break
        capped, level = row[0], (total - (row[1] or 0.0)) / row[2]
    return sources.withColumn("target", F.least(cap, F.lit(float(level)) * weight))


def plan(rows: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Per source: source_size, target, _epochs, _rest (words beyond epochs)."""
    sources = rows.groupBy("_src").agg(F.sum("_size").alias("source_size"))
    sources = stored(weighted(stored(sources, "mix-sources"), weights), "mix-weights")
    size = F.greatest(F.col("source_size"), F.lit(1))
    epochs = F.floor(F.col("target") / size)
    out = targets(sources, share, most).withColumn("_epochs", epochs)
    rest = F.round(F.col("target") - F.col("_epochs") * F.col("source_size")).cast("long")
    return stored(out.withColumn("_rest", rest), "mix-plan")


def cuts(slim: DataFrame, sources: DataFrame) -> tuple[DataFrame, int]:
    """(_src, _end, _before): the bucket in which a source's rest ends, the words before it; and how
    many low bits of _place are within a bucket. Each round cuts the buckets of the one before."""
    found = sources.select("_src", "_rest", F.lit(0).cast("long").alias("_end"), F.lit(0).cast("long").alias("_before"))
    shift = LEVEL_BITS * LEVELS
    while True:
        inside = slim.join(found, "_src").where(F.shiftright("_place", shift) == F.col("_end"))
        shift -= LEVEL_BITS
        sums = inside.groupBy("_src", F.shiftright("_place", shift).alias("_bucket"), "_rest", "_before").agg(F.sum("_size").alias("_sum"), F.count("*").alias("_n"))
        before = F.sum("_sum").over(Window.partitionBy("_src").orderBy("_bucket")) - F.col("_sum") + F.col("_before")
        sums = sums.withColumn("_until", before).where((F.col("_until") < F.col("_rest")) & (F.col("_until") + F.col("_sum") >= F.col("_rest")))
        found = stored(sums.select("_src", "_rest", F.col("_bucket").alias("_end"), F.col("_until").alias("_before"), "_n"), "mix-ends")
        if not shift or (found.agg(F.max("_n")).first()[0] or 0) <= LAST_ROWS:
            return found.select("_src", "_end", "_before"), shift


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: list[str] | None = None, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, quality_col: str | None = None, seed: int = 0) -> DataFrame:
    """The kept columns (all if None), size, source_size, target and taken; such columns give way."""
    # internal names, so that no column of docs can clash
    given = list(docs.columns)
    inner = {c.lower(): f"_c{i}" for i, c in enumerate(given)}
    out = keep if keep is not None else [c for c in given if c.lower() not in ("size", "source_size", "target", "taken")]
    held = [F.col(inner[c.lower()]) for c in out]
    rows = sized(docs.toDF(*inner.values()), inner[id_col.lower()], inner[text_col.lower()], inner[source_col.lower()], inner[quality_col.lower()] if quality_col else None, seed)
    own = ["_src", "_size", "_key", "_place"]
    if keep is not None and text_col not in keep:
        # without texts the rows are small: read and counted once
        rows = slim = stored(rows.select(*held, *own), "mix-rows")
    else:
        slim = stored(rows.select(*own), "mix-keys")
    sources = plan(slim, weights, share, most)
    ends, shift = cuts(slim.select("_src", "_size", "_place"), sources)
    sources = stored(sources.join(ends, "_src", "left"), "mix-cuts")
    bucket = F.shiftright("_place", shift)
    # in the bucket where the rest ends: words before each (key, size), of all rows that share it
    last = slim.select(*own).join(sources, "_src").where(bucket == F.col("_end"))
    ranked = last.groupBy("_src", "_key", "_size", "_before").agg(F.sum("_size").alias("_sum"))
    until = F.sum("_sum").over(Window.partitionBy("_src").orderBy("_key", "_size")) - F.col("_sum") + F.col("_before")
    ranked = stored(ranked.select("_src", "_key", "_size", until.alias("_until")), "mix-last")
    full = rows.select(*held, *[F.col(c) for c in own]).join(sources, "_src").withColumn("_bucket", bucket)
    inside = F.coalesce(F.col("_bucket") == F.col("_end"), F.lit(False))
    sure = full.where(~inside).withColumn("_part", F.when(F.col("_bucket") < F.col("_end"), F.col("_size")).otherwise(0))
    # equal rows of the last bucket share what is left of the rest, in one order or another
    nth = F.row_number().over(Window.partitionBy("_src", "_key", "_size").orderBy("_bucket")) - 1
    edge = full.where(inside).join(ranked, ["_src", "_key", "_size"]).withColumn("_left", F.col("_rest") - F.col("_until") - nth * F.col("_size"))
    edge = edge.withColumn("_part", F.greatest(F.lit(0), F.least("_size", "_left")))
    taken = (F.col("_epochs") * F.col("_size") + F.col("_part")).cast("long").alias("taken")
    names = [*held, F.col("_size").alias("size"), F.col("source_size"), F.col("target"), taken]
    return sure.select(*names).union(edge.select(*names)).toDF(*out, "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself, columns as given: a row for each whole time a document is taken,
    and one with its first words for a part."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    at = {c.lower(): n for c, n in zip(docs.columns, names)}
    text = at[text_col.lower()]
    rows = mix(docs.toDF(*names), at[id_col.lower()], text, at[source_col.lower()], **options)
    size = F.greatest(F.col("size"), F.lit(1))
    whole, part = F.floor(F.col("taken") / size), F.col("taken") % size
    copies = F.concat(F.array_repeat(F.lit(None).cast("long"), whole.cast("int")), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<long>")))
    pieces = F.regexp_extract_all(F.col(text), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    first = F.array_join(F.slice(pieces, 1, F.coalesce(F.col("_copy"), F.lit(0)).cast("int")), "")
    out = rows.where("taken > 0").withColumn("_copy", F.explode(copies))
    return out.withColumn(text, F.when(F.col("_copy").isNull(), F.col(text)).otherwise(first)).select(*names).toDF(*docs.columns)
