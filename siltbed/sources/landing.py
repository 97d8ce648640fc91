"""Landing files of JSON lines, staging tables, snapshots and incremental reads."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions import marks
from siltbed.functions.canonical import quoted

SEGMENT = re.compile(r"[A-Za-z0-9_.\-]+")
STAMP = re.compile(r"\d{14}")
RUN_COLUMN = "_staging_run_id"


def safe_segment(name: str) -> str:
    if not SEGMENT.fullmatch(name or "") or name in (".", ".."):
        raise ValueError(f"{name!r} is not a safe path segment")
    return name


def is_safe_segment(name: Column) -> Column:
    return F.coalesce(name.rlike(r"^[A-Za-z0-9_.\-]+$") & ~name.isin(".", ".."), F.lit(False))


def landing_path(source_system: str, source_table: str, stamp: str) -> str:
    """system/table/table_yyyyMMddHHmmss.json"""
    if not STAMP.fullmatch(stamp or ""):
        raise ValueError(f"a run time is 14 digits, not {stamp!r}")
    s, t = safe_segment(source_system), safe_segment(source_table)
    return f"{s}/{t}/{t}_{stamp}.json"


def landing_paths(system: Column, table: Column, stamp: Column) -> Column:
    """The same as a column; NULL where a part is not safe."""
    ok = is_safe_segment(system) & is_safe_segment(table) & stamp.rlike(r"^\d{14}$")
    return F.when(ok, F.concat(system, F.lit("/"), table, F.lit("/"), table, F.lit("_"), stamp, F.lit(".json")))


def stamp_of(file_name: Column, table: str) -> Column:
    """The run time in a landing file's name; NULL if it is not one of the table's."""
    return F.nullif(F.regexp_extract(file_name, rf"^{re.escape(table)}_(\d{{14}})\.json$", 1), F.lit(""))


def read_landing(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """JSON lines, every column text: absent fields are NULL, numbers stay as written."""
    return spark.read.schema(", ".join(f"{quoted(c)} string" for c in columns)).json(path)


def write_landing(df: DataFrame, root: str, source_system: str, source_table: str, stamp: str) -> str:
    """Writes a new landing path; an error if it is there already."""
    path = f"{root.rstrip('/')}/{landing_path(source_system, source_table, stamp)}"
    df.write.mode("errorifexists").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return path


def replay_files(files: DataFrame, table: str, since: str | None = None, exact: str | None = None) -> DataFrame:
    """Files (file_name) to replay with their stamp, oldest first: of one time, from a time on, or the latest."""
    own = files.withColumn("stamp", stamp_of(F.col("file_name"), table)).where("stamp is not null")
    if exact:
        own = own.where(F.col("stamp") == exact)
    elif since:
        own = own.where(F.col("stamp") >= since)
    else:
        own = own.join(own.agg(F.max("stamp").alias("_last")), F.col("stamp") == F.col("_last")).drop("_last")
    return own.orderBy("stamp", "file_name")


def stage(df: DataFrame, path: str, run_id: str) -> None:
    """Overwrites a staging path with rows stamped by the run."""
    df.withColumn(RUN_COLUMN, F.lit(run_id)).write.mode("overwrite").parquet(path)


def staged(df: DataFrame, run_id: str) -> DataFrame:
    return df.where(F.col(RUN_COLUMN) == run_id)


def truncate(spark: SparkSession, path: str) -> None:
    """Empties a staging path and keeps its schema."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def extract(df: DataFrame, columns: Sequence[str], mark: str | None = None, after: object = None, inclusive: bool = False, extra: Column | None = None) -> DataFrame:
    """The columns of rows past a mark: a typed literal, so that it reaches the scan.

    Strictly greater unless inclusive; rows of a NULL mark come with a full read only.
    """
    out = df
    if mark and after is not None:
        literal = F.lit(after).cast(df.schema[mark].dataType)
        out = out.where(F.col(quoted(mark)) >= literal if inclusive else F.col(quoted(mark)) > literal)
    if extra is not None:
        out = out.where(extra)
    return out.select(*[F.col(quoted(c)) for c in columns])


#: What a statement of the metadata's own has where the mark goes.
PLACEHOLDER = "{watermark}"


def extract_override(spark: SparkSession, statement: str, kind: str, mark: str | None, **tables: DataFrame) -> DataFrame:
    """Rows of a statement that replaces the extract: its `{watermark}` is bound to the mark, typed by its kind.

    mark: canonical text; where there is none yet, the kind's floor is bound. The value is a
    parameter and never part of the text. Tables are named in braces: `FROM {orders}`.
    """
    if kind not in marks.FLOORS:
        raise ValueError(f"unknown mark type {kind!r}")
    value = marks.FLOORS[kind] if mark is None else mark
    # whole numbers bind as such, so that a comparison reaches the scan
    number = "BIGINT" if re.fullmatch(r"-?\d{1,18}", value) else "DECIMAL(38,10)"
    typed = {marks.DATETIME: "CAST(:watermark AS TIMESTAMP_NTZ)", marks.NUMERIC: f"CAST(:watermark AS {number})", marks.STRING: ":watermark"}[kind]
    return spark.sql(statement.replace(PLACEHOLDER, typed), args={"watermark": value}, **tables)


def write_snapshot(df: DataFrame, root: str, by: Sequence[str] = ()) -> str:
    """Writes a new version below root, in folders `by` columns, then points to it; readers see the old or the new one.

    A version is a folder of its own, so the plan that is being read is never
    overwritten. The pointer is the newest complete folder (with _SUCCESS); one that a
    failed write left behind is written anew.
    """
    versions = snapshot_versions(df.sparkSession, root)
    path = f"{root.rstrip('/')}/v={(versions[-1] + 1) if versions else 0:08d}"
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return path


def _folder(spark: SparkSession, path: str) -> tuple:
    """A path, its file system, and the class of paths."""
    kind = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    p = kind(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), kind


def snapshot_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions below root, ascending."""
    path, fs, kind = _folder(spark, root)
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path)]
    return sorted(int(p.getName()[2:]) for p in found if p.getName().startswith("v=") and fs.exists(kind(p, "_SUCCESS")))


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    versions = snapshot_versions(spark, root)
    return spark.read.parquet(f"{root.rstrip('/')}/v={versions[-1]:08d}") if versions else None


def expire_snapshots(spark: SparkSession, root: str, keep: int = 2, only: str | None = None) -> list[str]:
    """Removes all but the newest `keep` complete versions, or of these older ones only a folder (`state=current`)."""
    gone = []
    for v in snapshot_versions(spark, root)[: -max(keep, 1)]:
        name = f"{root.rstrip('/')}/v={v:08d}" + (f"/{only}" if only else "")
        path, fs, _ = _folder(spark, name)
        if fs.exists(path):
            fs.delete(path, True)
            gone.append(name)
    return gone


def read_states(spark: SparkSession, root: str, column: str, latest: str, schema: T.StructType | None = None, states: Sequence[str] | None = None) -> DataFrame | None:
    """Versions below root that are parted by a column: the rows `latest` of the newest, other rows of all of them.

    What one version says of the latest rows the next one replaces; other rows are added
    and stay. Folders of no use are pruned before files are listed for a scan. states: only these.
    """
    versions = snapshot_versions(spark, root)
    if not versions:
        return None
    newest = f"{root.rstrip('/')}/v={versions[-1]:08d}"
    kind = schema or spark.read.parquet(newest).drop(column).schema
    parts = T.StructType([T.StructField(column, T.StringType()), T.StructField("v", T.IntegerType())])
    rows = spark.read.schema(T.StructType([*kind.fields, *parts.fields])).parquet(root)
    own, v, n = F.col(quoted(column)), F.col("v"), versions[-1]
    rows = rows.where(((own == latest) & (v == n)) | ((own != latest) & (v <= n)))
    return (rows.where(own.isin(*states)) if states else rows).drop("v")


def write_part(df: DataFrame, root: str, column: str) -> None:
    """Overwrites only the folders of the column's values that df has: what other runs wrote stays as it is."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(root)


def clear_part(spark: SparkSession, root: str, column: str, value: str) -> None:
    """Removes the folder of one value, for a run that has no rows (any more)."""
    path, fs, kind = _folder(spark, root)
    if fs.exists(path):
        escaped = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
        fs.delete(kind(path, f"{column}={escaped}"), True)


def read_parts(spark: SparkSession, root: str, column: str) -> DataFrame | None:
    """A table in folders of a text column; columns that some folders lack are NULL there."""
    path, fs, _ = _folder(spark, root)
    if not fs.exists(path) or not any(s.getPath().getName().startswith(f"{column}=") for s in fs.listStatus(path)):
        return None
    found = spark.read.option("mergeSchema", True).parquet(root).schema
    # run ids that look like numbers would be read as such
    kind = [T.StructField(f.name, T.StringType()) if f.name == column else f for f in found]
    return spark.read.schema(T.StructType(kind)).parquet(root)
