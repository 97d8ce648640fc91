"""New landing files as a stream: the checkpoint knows which files were taken."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from siltbed.functions.canonical import quoted
from siltbed.plans import job
from siltbed.plans.spec import EntitySpec
from siltbed.sources import landing

#: What a stream keeps between batches: a row an entity.
MARKS = "entity long, mark string"


class LoadStopped(Exception):
    """A rule failed: the batch's files stay untaken, and the next start tries them again."""


def landing_stream(spark: SparkSession, path: str, columns: Sequence[str], files_per_batch: int | None = None) -> DataFrame:
    """JSON lines of a landing folder, every column text, files in order of their time."""
    reader = spark.readStream.schema(", ".join(f"{quoted(c)} string" for c in columns))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def load_available(stream: DataFrame, checkpoint: str, process: Callable[[DataFrame, str], None]) -> StreamingQuery:
    """Hands what is new to process(batch, entity_run_id), then ends.

    The id of a micro-batch is the id of its load: a batch that is tried again
    replaces its own rows.
    """
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: process(df, f"batch-{n:08d}")).trigger(availableNow=True).start()


def read_marks(spark: SparkSession, root: str) -> DataFrame:
    """The marks that the last batch left below root."""
    found = landing.read_snapshot(spark, f"{root.rstrip('/')}/marks")
    return spark.createDataFrame([], MARKS) if found is None else found


def load_stream(spec: EntitySpec, stream: DataFrame, root: str, checkpoint: str, now: Callable[[str], str], **options) -> StreamingQuery:
    """One whole job.load a micro-batch: stage, rules, target by strategy, rules, mark; then ends.

    Target and marks are below root and carried from batch to batch. The batch's id is the
    run's, so a batch that is tried again after a failure finds its own rows and changes
    nothing twice; marks are written last. A rule that stops a load stops the stream.
    now(run id) is the time that a run's rows get. options: those of job.load.
    """
    home = root.rstrip("/")

    def one(batch: DataFrame, run: str) -> None:
        spark = batch.sparkSession
        done = job.load(spec, batch, home, read_marks(spark, home), run, f"{run}-E{spec.entity_id}", now(run), **options)
        if not done.succeeded:
            failed = [f"{r.rule_name} ({r.failed_row_count})" for x in (done.report, done.post) if x is not None for r in x.where("status = 'FAILED'").collect()]
            raise LoadStopped(f"{run}: {', '.join(failed)}")
        landing.write_snapshot(done.marks.coalesce(1), f"{home}/marks")

    return load_available(stream, checkpoint, one)
