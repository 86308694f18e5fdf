"""Exact row numbers, chunks and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunklake.functions.text import label
from chunklake.sources.shared import materialize

CHUNK, BATCH, FANOUT = 10_000, 1_000, 10


def number(df: DataFrame, *order: str, name: str = "ordinal") -> DataFrame:
    """``df`` with its rows numbered from 0 in ``order``, without one task for all.

    Rows are sorted over all partitions and written; a partition's numbers
    start where those of the partitions before it end.  ``order`` should tell
    rows apart; ties are numbered in any order, once.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition; the window is over those, and they go to where the rows are.
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    counts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.col("_at").bitwiseAND((1 << 33) - 1)
    return placed.join(F.broadcast(counts), "_part").withColumn(name, F.col("_before") + within).drop("_at", "_part", "_before")


def chunk(df: DataFrame, *order: str, size: int = CHUNK) -> DataFrame:
    """With ``chunk_no``, ``chunk_label`` and ``idx``, the place in the chunk from 0."""
    numbered = number(df, *order)
    chunked = numbered.withColumn("chunk_no", F.expr(f"cast(ordinal div {size} as int)")).withColumn("idx", F.expr(f"cast(ordinal % {size} as int)"))
    return chunked.withColumn("chunk_label", label(F.col("chunk_no")))


def manifest(chunked: DataFrame) -> DataFrame:
    return chunked.groupBy("chunk_no", "chunk_label").agg(F.count("*").alias("rows"))


def summary(rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """Rows and chunks of each library."""
    counted = rows.groupBy("library").agg(F.count("*").alias("total"))
    return counted.withColumn("chunks", F.expr(f"(total + {size - 1}) div {size}"))


def batches(position: str = "position", size: int = BATCH) -> list:
    """Columns ``batch`` and ``task`` of a position in a work list."""
    return [F.expr(f"{position} div {size}").alias("batch"), F.expr(f"cast({position} % {size} as int)").alias("task")]


def split_ranges(ranges: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Ranges (start, end inclusive) cut into ``fanout`` parts or fewer, equal but the last."""
    cut = ranges.withColumn("_n", F.expr("`end` - start + 1")).withColumn("_k", F.least(F.col("_n"), F.lit(fanout)))
    cut = cut.withColumn("_piece", F.expr("(_n + _k - 1) div _k"))
    cut = cut.withColumn("_i", F.explode(F.expr("sequence(0L, cast((_n - 1) div _piece as bigint))")))
    first = F.col("start") + F.col("_i") * F.col("_piece")
    return cut.withColumn("end", F.least(first + F.col("_piece") - 1, F.col("end"))).withColumn("start", first).drop("_n", "_k", "_piece", "_i")
