"""Incremental runs: new and changed files, resumed work, attempts until complete."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chunklake.sources.open_files import fields_of
from chunklake.sources.published import current, newest, publish
from chunklake.sources.shared import materialize
from chunklake.sources.text_files import list_files

_STATE = "path string, length long, modified timestamp, load string"
NEW, CHANGED, GONE, SAME = "NEW", "CHANGED", "GONE", "SAME"
DONE, DUE, WAITING, QUARANTINED = "DONE", "DUE", "WAITING", "QUARANTINED"


def pending(rows: DataFrame, done: DataFrame, on: str | list[str]) -> DataFrame:
    """The rows that have no result yet.  Results are about as many as rows, so their keys are never sent to the driver to be broadcast."""
    return rows.join(done.select(on).hint("merge"), on, "left_anti")


def write_batch(batch: DataFrame, number: int, target: str) -> None:
    """The rows of a micro-batch as a folder of its number.  A batch that comes again, because
    the run ended before its number was recorded, takes the place of what it had written."""
    batch.write.mode("overwrite").parquet(f"{target}/batch={number}")


def ingest(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], at_once: int | None = None) -> StreamingQuery:
    """Read the parquet files below ``source`` that are new since the last run, and add
    ``transform`` of them to ``target``, each row once.  Ends when all are read.

    ``target`` has the column ``batch`` besides.  A batch has ``at_once`` files at most.  A file rewritten under its name is not read again:
    :func:`ingest_files` does that.
    """
    options = {} if at_once is None else {"maxFilesPerTrigger": at_once}
    stream = transform(spark.readStream.schema(schema).options(**options).parquet(source))
    writer = stream.writeStream.foreachBatch(lambda batch, number: write_batch(batch, number, target))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def changes(spark: SparkSession, source: str, target: str, pattern: str) -> DataFrame:
    """(path, length, modified, load, change) of the files below ``source`` and of those read before:
    NEW, CHANGED (another length or time), GONE or SAME."""
    now = list_files(spark, source, pattern, missing_ok=True).select("path", "length", F.col("modificationTime").alias("modified"))
    before = current(spark, f"{target}/files", _STATE).select("path", F.struct("length", "modified").alias("_then"), "load")
    both = now.join(before, "path", "full")
    change = F.when(F.col("_then").isNull(), NEW).when(F.col("modified").isNull(), GONE).when(F.struct("length", "modified") != F.col("_then"), CHANGED).otherwise(SAME)
    return both.select("path", "length", "modified", "load", change.alias("change"))


def csv_rows(columns: list[str], sep: str = ",") -> Callable[[DataFrame], DataFrame]:
    """A reader for :func:`ingest_files`: ``columns`` of CSV files of any header, '' where one is missing."""

    def read(paths: DataFrame) -> DataFrame:
        found = fields_of(paths, sep).where("idx >= 0").withColumn("_row", F.map_from_arrays("names", "fields"))
        return found.select("path", "idx", *[F.coalesce(F.try_element_at("_row", F.lit(c)), F.lit("")).alias(c) for c in columns])

    return read


def ingest_files(spark: SparkSession, source: str, target: str, read: Callable[[DataFrame], DataFrame], pattern: str = r"\.csv$") -> dict[str, int]:
    """Bring ``target`` up to the files below ``source``; returns how many were new, changed, gone and the same.

    ``read`` gives the rows of a frame of paths, with a column ``path``: :func:`csv_rows`, or archives.
    The rows of new and changed files are written under the name of this load.  Then the list of files, which says in which load each
    file's rows are, is published as a whole: that takes a changed file's former rows out, and a gone file's, and puts
    the new ones in, at once.  A run that ends before that has changed nothing, and the next one does its work
    again, without a row twice.  Two runs at once: one of them gets Conflict.
    """
    state = f"{target}/files"
    seen, load = newest(spark, state), f"load-{uuid.uuid4().hex}"
    found = materialize(changes(spark, source, target, pattern), "changes")
    counts = {NEW: 0, CHANGED: 0, GONE: 0, SAME: 0} | {r.change: r["count"] for r in found.groupBy("change").count().collect()}  # four at most
    if counts[NEW] or counts[CHANGED] or counts[GONE] or seen is None:
        fresh = F.col("change").isin(NEW, CHANGED)
        read(found.where(fresh).select("path")).write.parquet(f"{target}/rows/_load={load}")
        kept = found.where(F.col("change") != GONE).select("path", "length", "modified", F.when(fresh, load).otherwise(F.col("load")).alias("load"))
        publish(kept, state, expect=seen["version"] if seen else 0)
    return counts


def ingested(spark: SparkSession, target: str) -> DataFrame:
    """The rows of the files as they were when last read, with ``path``."""
    files = current(spark, f"{target}/files").select("path", F.col("load").alias("_load"))
    rows = spark.read.parquet(f"{target}/rows")
    return rows.join(files, ["path", "_load"], "left_semi").drop("_load")


def resume(rows: DataFrame, done: DataFrame, on: str, run: Callable[[DataFrame], DataFrame], target: str) -> DataFrame:
    """Run what is pending and append its results to ``target``; returns the rows that remain.

    Results are complete for a key once they are written, so that a run which
    broke off goes on with what it had not done.
    """
    run(pending(rows, done, on)).write.mode("append").parquet(target)
    return pending(rows, rows.sparkSession.read.parquet(target), on)


def until_complete(rows: DataFrame, on: str, run: Callable[[DataFrame], DataFrame], target: str, most: int = 5) -> tuple[DataFrame, int]:
    """Resume until nothing is pending, a round gets nothing done, or ``most`` rounds are over.

    ``target`` is a table that exists.  Returns the rows that remain and the rounds taken.
    """
    left, turns = None, 0
    remain = materialize(pending(rows, rows.sparkSession.read.parquet(target), on), "pending")
    while turns < most and (now := remain.count()) not in (0, left):
        # A round is over what the one before left: all rounds together take little more than the first.
        made = materialize(run(remain), "round")
        made.write.mode("append").parquet(target)
        remain, left, turns = materialize(pending(remain, made, on), "pending"), now, turns + 1
    return remain, turns


def attempt_states(rows: DataFrame, on: str, attempts: DataFrame, most: int = 3, wait: float = 0.0) -> DataFrame:
    """(on, tries, state, details) of each key of ``rows``, by the table of ``attempts`` (on, ok, details, at).

    DONE once an attempt was ok; QUARANTINED after ``most`` that were not; WAITING for ``wait`` seconds after the
    first failure, twice as long after the second and so on; otherwise DUE.  ``details`` are those of the last failure.
    """
    keyed = attempts.groupBy(on).agg(F.count_if(~F.col("ok")).alias("tries"), F.bool_or("ok").alias("_done"), F.max("at").alias("_last"), F.max_by("details", F.when(~F.col("ok"), F.col("at"))).alias("details"))
    tries = F.coalesce("tries", F.lit(0))
    back = F.col("_last").cast("double") + wait * F.pow(F.lit(2.0), tries - 1) > F.current_timestamp().cast("double")
    state = F.when(F.col("_done"), DONE).when(tries >= most, QUARANTINED).when(tries.isNotNull() & (tries > 0) & back, WAITING).otherwise(DUE)
    return rows.select(on).distinct().join(keyed, on, "left").select(on, tries.alias("tries"), state.alias("state"), F.coalesce("details", F.lit("")).alias("details"))


def attempt(rows: DataFrame, on: str, run: Callable[[DataFrame], DataFrame], target: str, most: int = 3, wait: float = 0.0) -> int:
    """Run what is due, and append an attempt for each key to the table ``target``; returns how many were due.

    ``run`` gives for the rows it is given ``on``, ``ok``, ``details`` and results.  Results and attempts are one table, so that
    neither is there without the other; ``target`` need not exist.  A key is due until :func:`attempt_states` says otherwise.
    """
    spark = rows.sparkSession
    due = attempt_states(rows, on, attempts(spark, target, on, rows), most, wait).where(F.col("state") == DUE)
    n = due.count()
    if n:
        run(rows.join(due.select(on), on, "left_semi")).withColumn("at", F.current_timestamp()).write.mode("append").parquet(target)
    return n


def attempts(spark: SparkSession, target: str, on: str, rows: DataFrame) -> DataFrame:
    """The table of attempts, empty before the first one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.read.parquet(target)
    return spark.createDataFrame([], f"`{on}` {rows.schema[on].dataType.simpleString()}, ok boolean, details string, at timestamp")


def checkpoint_rows(rows: DataFrame, order: str, index: str = "__idx__") -> DataFrame:
    """The last row for each index of a checkpoint that was read as strings; rows whose
    index is missing or not a number are left out."""
    known = rows.withColumn(index, F.expr(f"try_cast(trim(`{index}`) AS int)")).where(F.col(index).isNotNull())
    return latest(known, index, order)


def latest(events: DataFrame, on: str, order: str) -> DataFrame:
    """The last row of each key: of checkpoint rows with one index, the later counts.

    Rows of a key that share the last ``order`` are ties, of which any one is taken; rows with a null order come first.
    """
    value = F.max_by(F.struct("*"), F.col(order))
    return events.groupBy(on).agg(value.alias("_v")).select("_v.*")
