"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.sources.shared import materialize, release, shared_dir

#: A word is a run of bytes that are neither blank nor one of \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


__all__ = ["WORD", "drop_tables", "give_back", "keyed_rows", "materialize", "release", "shared_dir", "table", "texts", "whole_rows"]


def drop_tables(spark: SparkSession) -> None:
    """Delete what :func:`materialize` has written in this application."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/chunklake/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """This Python gives back to the system what it has freed: Arrow and the C library keep it for later, beside a JVM whose heap is still to grow."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL(None).malloc_trim(0)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) and the columns ``more``, no others."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def whole_rows(docs: DataFrame, *names: str) -> DataFrame:
    """``names``, and all columns of ``docs`` in ``whole``, so that none clashes with those made on the way."""
    return docs.select(*names, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"))


def keyed_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``, which tells its rows apart and orders them.

    It is the id where ids are unique and not null; otherwise rows are numbered
    in the order of the table, and the numbers fixed by writing it.
    """
    n, ids, known = docs.agg(F.count("*"), F.count_distinct("doc_id"), F.count("doc_id")).first()
    if n == ids == known:
        return docs.withColumn("_row", F.col("doc_id").cast("long"))
    return materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
