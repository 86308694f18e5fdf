"""CSV and result files: reading and writing with the csv module's conventions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.functions.text import CHUNK_FILE, RANGE_FILE, RESULT_FILE, number_in
from chunklake.sources.chunk_sink import store_of
from chunklake.sources.open_files import read_open, separator

# Doubled quotes, a backslash is data, fields of up to 10 MB.
OPTIONS = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "maxCharsPerColumn": 10485760, "enforceSchema": False}
#: Bytes in which a line that names a delimiter is looked for.
FIRST_LINE = 64


def _peek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which of the files begin with a line that names the delimiter."""
    for batch in batches:
        marked = []
        for path in batch.column("path").to_pylist():
            store, inner = store_of(path)
            with store.open_input_stream(inner) as f:
                start = f.read(FIRST_LINE).decode("utf-8-sig", "replace")
            marked.append(separator(start.splitlines()[0] if start else "") is not None)
        yield pa.record_batch({"path": batch.column("path"), "marked": pa.array(marked, pa.bool_())})


def read_csv(spark: SparkSession, path: str | list[str], sep: str = ",", **options) -> DataFrame:
    """All columns as strings, '' where a field is empty or missing.

    In each file a first line ``sep=`` names the delimiter and is no header; the line after it is.
    Such files are parsed each by one task that holds the file whole, and their columns united by name with those of the others.
    Spark reads the others; as quotes may hold line ends, each of them in one task too, unless ``multiLine=False``
    says that they hold none, which lets large files be split.
    """
    listing = spark.read.format("binaryFile").options(recursiveFileLookup=True, **{k: v for k, v in options.items() if k == "pathGlobFilter"})
    peeked = listing.load(path).where("length > 0").select("path").mapInArrow(_peek, "path string, marked boolean")
    marked = [r.path for r in peeked.where("marked").toLocalIterator()]
    plain = spark.read.options(**(OPTIONS | {"sep": sep} | options))
    if not marked:
        return plain.csv(path).fillna("")
    frames = [read_open(spark, marked, ".", sep).drop("_path", "_idx")]
    if others := [r.path for r in peeked.where("not marked").toLocalIterator()]:
        frames.append(plain.csv(others))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).fillna("")


def first_column(df: DataFrame, name: str = "smiles") -> DataFrame:
    """The first column of a file, whatever its header says."""
    return df.select(F.col(f"`{df.columns[0]}`").alias(name))


def list_files(spark: SparkSession, path: str, pattern: str, missing_ok: bool = False) -> DataFrame:
    """(path, length, modificationTime) of the files below ``path`` whose name matches; contents are not read.

    A folder that is not there is an error, or with ``missing_ok`` has no files.
    """
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    except AnalysisException as e:
        if not missing_ok or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    return found.where(F.regexp_extract(F.substring_index("path", "/", -1), pattern, 0) != "")


def chunk_numbers(spark: SparkSession, path: str, pattern: str = CHUNK_FILE) -> DataFrame:
    """(chunk_no) of the numbered files below ``path``; none if there is no such folder."""
    files = list_files(spark, path, pattern, missing_ok=True)
    return files.select(number_in(F.substring_index("path", "/", -1), pattern).alias("chunk_no")).where("chunk_no is not null").distinct()


def first_file(spark: SparkSession, path: str, pattern: str = CHUNK_FILE) -> str | None:
    """The first matching file by name."""
    return list_files(spark, path, pattern, missing_ok=True).agg(F.min("path")).first()[0]


def libraries(spark: SparkSession, root: str, model: str | None = None) -> DataFrame:
    """(library), sorted: the folders right below ``root`` that hold files, or files in a folder ``model``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    inner = F.split(F.element_at(F.split("path", re.escape(root.rstrip("/").split("://")[-1].lstrip("/")) + "/", 2), 2), "/")
    held = files.select(inner.alias("p")).where(F.size("p") > 1)
    held = held if model is None else held.where((F.size("p") > 2) & (F.get("p", F.lit(1)) == model))
    return held.select(F.get("p", F.lit(0)).alias("library")).distinct().orderBy("library")


def read_chunks(spark: SparkSession, path: str, pattern: str = RESULT_FILE) -> DataFrame:
    """Numbered files under one schema, with ``chunk_no``, whatever header each of them has.

    Columns are united by name, so that another order of columns does not swap them.
    """
    rows = read_open(spark, path, pattern)
    return rows.withColumn("chunk_no", number_in(F.substring_index("_path", "/", -1), pattern)).drop("_path", "_idx")


def write_chunks(chunked: DataFrame, path: str, *columns: str, **options) -> None:
    """One folder for each chunk below library= and chunk_no=, rows in order.

    Spark writes them; numbered files are written by :func:`chunk_sink.export_chunks`.
    """
    keys = [c for c in ("library", "chunk_no") if c in chunked.columns]
    placed = chunked.repartition(*keys).sortWithinPartitions(*keys, "idx").select(*keys, *columns)
    writer = placed.write.partitionBy(*keys).mode("overwrite").options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **options)
    if len(columns) > 1:  # alone in its line, an empty value has to be quoted
        writer = writer.option("emptyValue", "")
    writer.csv(path)


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Fragments ``result_START_END.csv`` under one schema, with ``file``, ``start``, ``end`` and ``idx``,
    the row's place in the chunk: START and its place in the file."""
    rows = read_open(spark, path, RANGE_FILE)
    number = lambda group: F.regexp_extract(F.substring_index("_path", "/", -1), RANGE_FILE, group).cast("bigint")
    rows = rows.withColumns({"start": number(1), "end": number(2)}).withColumn("idx", F.col("start") + F.col("_idx"))
    return rows.withColumnRenamed("_path", "file").drop("_idx")


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """Per file the lines after the first, however records are broken over lines."""
    lines = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("path")).count()
    return lines.select("path", (F.col("count") - 1).alias("rows"))
