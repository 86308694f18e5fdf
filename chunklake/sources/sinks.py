"""Merged files, failure reports, companion lists and the log of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.operators.merge import order_keys

# The columns of a failure report.
REPORT = ("library", "chunk_file", "smiles_position", "smiles", "status", "details")
_CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_merged(chunked: DataFrame, path: str, *columns: str, order: str = "numeric", dry_run: bool = False) -> DataFrame:
    """Write chunks as one ordered table of CSV part files; their names sort in row order.

    Returns what is written, by chunk.  With ``dry_run`` nothing is.
    """
    if not dry_run:
        rows = chunked.orderBy(*order_keys(order)).select(*columns)
        writer = rows.write.mode("overwrite").options(**_CSV)
        (writer.option("emptyValue", "") if len(columns) > 1 else writer).csv(path)
    return chunked.groupBy("chunk_no", "chunk_label").agg(F.count("*").alias("rows"))


def write_report(scored: DataFrame, path: str) -> None:
    """Every tested row with its verdict; positions count from 1."""
    rows = scored.withColumn("smiles_position", F.col("idx") + 1)
    rows.select(*REPORT).orderBy("library", "chunk_file", "smiles_position").write.mode("overwrite").options(**_CSV).option("emptyValue", "").csv(path)


def write_index(numbered: DataFrame, path: str, value: str, key: str) -> None:
    """One value for each line, in the order of ``key``."""
    numbered.orderBy(key).select(F.col(value).cast("string").alias("value")).write.mode("overwrite").text(path)


def log_run(spark: SparkSession, path: str, **facts: object) -> None:
    """Append a row to the log of runs: each fact as text, and when."""
    row = spark.createDataFrame([({k: str(v) for k, v in facts.items()},)], "facts map<string, string>")
    row.select("facts", F.current_timestamp().alias("at")).write.mode("append").parquet(path)
