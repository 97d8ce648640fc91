"""Small helpers that the corpus operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_own: dict[str, str] = {}
#: Paths that stored() has written and nothing has removed.
_written: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below spark.checkpoint.dir, the folder that driver and executors share.

    Only where that setting is absent and the master is local (tests, one machine)
    a temporary folder is made, once a session, and set on the context.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="siltbed-")
            spark.sparkContext.setCheckpointDir(_own[app])
        base = _own[app]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """The frame, written once to the shared folder and read again: lineage ends there."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.option("compression", compression).parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, df: DataFrame) -> None:
    """Removes the files of a stored() frame that nothing will read again."""
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _remove(spark, name)


def _remove(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _written[:] = [w for w in _written if w.rsplit("/", 1)[-1] != name.rsplit("/", 1)[-1]]


@contextmanager
def last_kept(spark: SparkSession) -> Iterator[None]:
    """Of what stored() writes within, the last table stays; the others, which it was made from, go."""
    before = set(_written)
    yield
    for path in [w for w in _written if w not in before][:-1]:
        _remove(spark, path)


def without(df: DataFrame, *names: str) -> list[Column]:
    """The columns of df but those that an operator is about to add, whatever their case."""
    taken = {n.lower() for n in names}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]


#: A key is hot if it has more than one in so many of the counted rows: fewer than this many keys are.
HOT_SHARE = 1000


def looked_up(rows: DataFrame, lookup: DataFrame, key: str, count: str, spread: Column) -> DataFrame:
    """rows with the columns of lookup (one row a key; null if there is none), without `count`.

    What lookup says of hot keys, fewer than HOT_SHARE rows whatever the table's
    size, is broadcast; their rows are dealt by `spread`, so that no task has all of a
    key. All others join by key. Internal names begin with two underscores.
    """
    values = [c for c in lookup.columns if c not in (key, count)]
    total = lookup.agg(F.sum(count)).first()[0] or 0
    hot = F.col(count) * HOT_SHARE > F.lit(total)
    packed = F.struct(*values)
    known = F.broadcast(lookup.where(hot).select(F.col(key).alias("__key"), packed.alias("__hot")))
    # 0 in all rows, but no literal: the optimizer would take that out of the join's keys
    zero = F.pmod(F.xxhash64(F.col(key)), F.lit(1)).cast("long")
    rest = lookup.where(~hot).select(F.col(key).alias("__key"), zero.alias("__salt"), packed.alias("__cold"))
    dealt = rows.join(known, F.col(key) == F.col("__key"), "left").drop("__key")
    dealt = dealt.withColumn("__salt", F.when(F.col("__hot").isNull(), F.lit(0)).otherwise(F.xxhash64(spread)).cast("long"))
    found = dealt.withColumnRenamed(key, "__key").join(rest, ["__key", "__salt"], "left")
    out = [F.col("__key").alias(key) if c == key else F.col(c) for c in rows.columns]
    return found.select(*out, *[F.coalesce(F.col(f"__hot.{v}"), F.col(f"__cold.{v}")).alias(v) for v in values])
