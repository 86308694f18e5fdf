"""Expected against actual: missing, extra, mismatched, empty; retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunklake.functions.text import percent


def missing(expected: DataFrame, actual: DataFrame, on: str) -> DataFrame:
    return expected.select(on).distinct().join(actual.select(on), on, "left_anti")


def present(expected: DataFrame, actual: DataFrame, on: str) -> DataFrame:
    return expected.select(on).distinct().join(actual.select(on), on, "left_semi")


def compare_counts(inputs: DataFrame, outputs: DataFrame, on: str) -> DataFrame:
    """Per key: rows in, rows out, and OK, MISMATCH or MISSING."""
    a = inputs.groupBy(on).agg(F.count("*").alias("rows_in"))
    b = outputs.groupBy(on).agg(F.count("*").alias("rows_out"))
    status = F.when(F.col("rows_out").isNull(), "MISSING").when(F.col("rows_out") != F.col("rows_in"), "MISMATCH").otherwise("OK")
    return a.join(b, on, "left").select(on, "rows_in", F.coalesce("rows_out", F.lit(0)).alias("rows_out"), status.alias("status"))


def completeness(expected: DataFrame, actual: DataFrame, on: str, by: str) -> DataFrame:
    """Per group ``by``: expected, present, missing and extra keys, and a status."""
    e = expected.select(by, on).distinct().withColumn("e", F.lit(1))
    a = actual.select(by, on).distinct().withColumn("a", F.lit(1))
    both = e.join(a, [by, on], "full").groupBy(by).agg(
        F.count("e").alias("expected"), F.count(F.when(F.col("e").isNotNull() & F.col("a").isNotNull(), 1)).alias("present"),
        F.count(F.when(F.col("a").isNull(), 1)).alias("missing"), F.count(F.when(F.col("e").isNull(), 1)).alias("extra"),
    )
    status = F.when(F.col("expected") == 0, "NO INPUT").when(F.col("present") == 0, "NOT RUN").when(F.col("missing") > 0, "INCOMPLETE").otherwise("COMPLETE")
    return both.withColumn("status", status)


def retention(rows: DataFrame, by: str, valid: Column, total: bool = False) -> DataFrame:
    """Input, valid and empty rows and the percentage kept; ``total`` adds the grand total,
    its percentage taken from the sums."""
    grouped = (rows.rollup(by) if total else rows.groupBy(by)).agg(F.count("*").alias("input"), F.count_if(valid).alias("valid"))
    return grouped.withColumn("empty", F.col("input") - F.col("valid")).withColumn("retention_pct", percent(F.col("valid"), F.col("input")))


def report(inputs: DataFrame, outputs: DataFrame, by: str, chunk: str, filled: Column, total: bool = True) -> DataFrame:
    """Per group ``by``: chunks, those missing, those whose number of rows differs, rows in and
    out, and empty rows (not ``filled``); ``total`` adds the grand total, with no group."""
    a = inputs.groupBy(by, chunk).agg(F.count("*").alias("rows_in"))
    b = outputs.groupBy(by, chunk).agg(F.count("*").alias("rows_out"), F.count_if(~filled).alias("empty"))
    both = a.join(b, [by, chunk], "left")
    counts = [
        F.count("*").alias("chunks"), F.count_if(F.col("rows_out").isNull()).alias("missing"), F.count_if(F.col("rows_out") != F.col("rows_in")).alias("mismatched"),
        F.sum("rows_in").alias("rows_in"), F.coalesce(F.sum("rows_out"), F.lit(0)).alias("rows_out"), F.coalesce(F.sum("empty"), F.lit(0)).alias("empty"),
    ]
    return (both.rollup(by) if total else both.groupBy(by)).agg(*counts)


def run_status(inputs: DataFrame, folders: DataFrame, results: DataFrame, by: str) -> DataFrame:
    """(by, status) of each group of ``inputs``: NO_OUTPUT_DIR without a folder, NO_RESULTS without a
    result in it, otherwise RUN."""
    held = inputs.select(by).distinct()
    held = held.join(folders.select(by).distinct().withColumn("_folder", F.lit(True)), by, "left").join(results.select(by).distinct().withColumn("_result", F.lit(True)), by, "left")
    return held.select(by, F.when(F.col("_folder").isNull(), "NO_OUTPUT_DIR").when(F.col("_result").isNull(), "NO_RESULTS").otherwise("RUN").alias("status"))


def preview(rows: DataFrame, by: str, item: str, first: int = 20) -> DataFrame:
    """Per group the first items in order, and how many more there are.

    Each task passes on the first few of each group only, so that no group has to be in one place.
    """
    place = F.row_number().over(Window.partitionBy(by).orderBy(item))
    some = rows.where(F.col(item).isNotNull()).select(by, item).withColumn("_place", place).where(F.col("_place") <= first)
    some = some.groupBy(by).agg(F.array_sort(F.collect_list(item)).alias("items"))
    counts = rows.groupBy(by).agg(F.greatest(F.count(item) - first, F.lit(0)).alias("more")).withColumnRenamed(by, "_by")
    none = F.array().cast(some.schema["items"].dataType)
    return counts.join(some, F.col("_by").eqNullSafe(some[by]), "left").select(F.col("_by").alias(by), F.coalesce("items", none).alias("items"), "more")


def verdict(rows: DataFrame, done: Column) -> DataFrame:
    """One row for a run: how many were to be done, how many are, and whether some are not.  No rows: nothing is missing."""
    incomplete = F.coalesce(F.bool_or(~F.coalesce(done, F.lit(False))), F.lit(False))
    return rows.agg(F.count("*").alias("ran"), F.count_if(done).alias("done"), incomplete.alias("incomplete"))


def vector_counts(rows: DataFrame, by: str, vector: str, width: int) -> DataFrame:
    """Per group: vectors, the longest one's length, and those that are not of ``width``, nulls among them."""
    size = F.size(vector)
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.max(size).alias("dim"), F.count_if(F.coalesce(size, F.lit(-1)) != width).alias("wrong"))


def fingerprint(rows: DataFrame, columns: list[str], *keys: str) -> DataFrame:
    """(keys, n, sum, xor): what a group's rows are, in whatever order they come, in one aggregation.

    Two groups whose rows differ agree with a probability of about 2^-128.  Null differs from every value; repeated rows count.
    """
    values = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    one, two = F.xxhash64(F.lit(0), *values), F.xxhash64(F.lit(1), *values)
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(one.cast("decimal(38,0)")).alias("sum"), F.bit_xor(two).alias("xor"))


def validity(inputs: DataFrame, results: DataFrame, *keys: str) -> DataFrame:
    """(keys, status): whether results are of the inputs that there are now.

    Both are fingerprints: of the inputs, and those kept with the results when they were made.
    VALID where they agree, STALE where the inputs have changed since, MISSING without a result, ORPHANED without an input.
    """
    marks = ("n", "sum", "xor")
    a = inputs.select(*keys, F.struct(*marks).alias("_now"))
    b = results.select(*keys, F.struct(*marks).alias("_then"))
    status = F.when(F.col("_then").isNull(), "MISSING").when(F.col("_now").isNull(), "ORPHANED").when(F.col("_now") != F.col("_then"), "STALE").otherwise("VALID")
    return a.join(b, list(keys), "full").select(*keys, status.alias("status"))
