"""Connected components by alternating large-star and small-star rounds.

Each round is two joins and two map-side-combined aggregates over the links, so
no group of neighbours is ever gathered in one task, and links never reach the
driver. Rounds are cut with tables in the shared folder.

Defined results: a link with a null end is no link; self-links and repeated links do no harm;
no links give no nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import forget, stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hooks every node's larger (large) or smaller (small) neighbours to its least one."""
    if large:
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hooked = both.join(least, "u")
    if large:
        out = hooked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hooked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """Links (u, v) to (node, root): root is the least node that node reaches.

    Nodes without a link do not appear; self-links and repeated links do no harm.
    """
    spark = links.sparkSession
    links = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = None
    while True:
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark, before = tuple(seen), links
        links = stored(_star(_star(links, True), False), "links")
        forget(spark, before)
    # every link is now (node, root), one per node
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
