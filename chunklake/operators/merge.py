"""Unions of chunks and results, and their order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunklake.operators.chunking import number


def by_name(frames: list[DataFrame]) -> DataFrame:
    """The frames' rows under the first one's columns; what a frame lacks is ''.

    A frame with a column that the first has not is refused.
    """
    columns = frames[0].columns
    for f in frames[1:]:
        if extra := set(f.columns) - set(columns):
            raise ValueError(f"columns that the first header has not: {sorted(extra)}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).select(*columns).fillna("")


def by_position(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


def order_keys(order: str = "numeric") -> list:
    """Sort keys of chunks: by number, or by label as text."""
    return [F.col("chunk_label" if order == "lexical" else "chunk_no"), F.col("idx")]


def pad(rows: DataFrame, results: DataFrame, on: str) -> DataFrame:
    """Each row with its results; '' where there is none.  Results win where names clash."""
    names = [c for c in results.columns if c != on]
    kept = rows.select(on, *[c for c in rows.columns if c != on and c not in names])
    joined = kept.join(results, on, "left")
    return joined.select(*kept.columns, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in names])


def gaps(ranges: DataFrame, sizes: DataFrame, *keys: str) -> DataFrame:
    """(keys, start, end): what of 0 to ``size`` - 1 no range (start, end, both inclusive) covers.

    ``sizes`` has a row for each of ``keys``.  Ranges are compared by their ends, in
    order; indices are not written out.
    """
    ends = sizes.select(*keys, F.col("size").alias("start"), F.lit(None).cast("bigint").alias("end"))
    both = ranges.select(*keys, "start", "end").union(ends)
    w = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    from_ = F.coalesce(F.max("end").over(w) + 1, F.lit(0))
    return both.withColumn("_from", from_).where("_from < start").select(*keys, F.col("_from").alias("start"), (F.col("start") - 1).alias("end"))


def uncovered(rows: DataFrame, ranges: DataFrame, size: int, on: str = "idx") -> DataFrame:
    """Indices of ``rows``, of 0 to ``size`` - 1, that no range (start, end) covers."""
    one = rows.sparkSession.createDataFrame([(0, size)], "_one int, size long")
    missing = gaps(ranges.select(F.lit(0).alias("_one"), "start", "end"), one, "_one")
    return rows.select(on).join(missing.select(F.explode(F.sequence("start", "end")).alias(on)), on, "left_semi")


def pair(left: DataFrame, right: DataFrame, left_order: str, right_order: str) -> DataFrame:
    """Rows of two tables side by side by their place, from 0 in ``pos``; as many as the shorter has."""
    return number(left, left_order, name="pos").join(number(right, right_order, name="pos"), "pos")
