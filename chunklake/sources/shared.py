"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.  Where it is unset and all tasks run in this
    process, as in tests, a temporary folder; elsewhere executors could not read one, so that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        found = _fallback.setdefault(app, f"file://{tempfile.mkdtemp(prefix='chunklake-')}")
    return found.rstrip("/")


#: Tasks for each core, at least, where work is not told by its bytes.
TASKS = 3


def tasks(spark: SparkSession) -> int:
    """A number of tasks for work of few bytes that takes long, such as many small files, which AQE would put into one."""
    return max(TASKS * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Bytes that go to a Python worker together, at most, but for one row.
BATCH = 2 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within, Arrow batches for Python workers hold ``BATCH`` bytes: Spark's own bound is 64 MB, of which a task has
    several copies, in the JVM and in its worker, and what a worker has once taken it gives back late.  A bound that the session sets itself holds."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is not None:
        yield
        return
    spark.conf.set(name, BATCH)
    try:
        yield
    finally:
        spark.conf.unset(name)


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there.  Python tasks on the way get small batches."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/chunklake/{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(table: DataFrame) -> None:
    """Delete a table of :func:`materialize` that nothing reads any more."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.inputFiles()[0].rpartition("/")[0])
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Have the driver's JVM collect garbage, so that Spark deletes the shuffle files of steps that are done; else they stay until a collection of its own.

    Right after a step something still refers to it (measured: nothing is deleted), so there is a second collection a second later.
    """
    for wait in (1, 0):
        spark.sparkContext._jvm.System.gc()
        time.sleep(wait)
