"""CSV files of any header, read as one table in one scan."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.functions.text import RESULT_FILE
from chunklake.sources.chunk_sink import store_of
from chunklake.sources.shared import materialize, tasks

LONGEST_FIELD = 10485760
#: Rows that go to Spark at once, and characters of their files.
TOGETHER, CHARS = 4096, 4 << 20
_FIELDS = "path string, idx long, names array<string>, fields array<string>"


def separator(line: str) -> str | None:
    """The delimiter that a file's first line names with ``sep=``, '' if it names none there; None if it is another line."""
    mark = line.lstrip("﻿").strip()
    return mark[4:] if mark.lower().startswith("sep=") else None


def records(text: str, sep: str) -> tuple[list[str], Iterator[list[str]]]:
    """A file's header and records.  A first line ``sep=`` is neither, and names the delimiter; empty lines
    are no records.  Only the first line and the header are taken for that, whatever the others hold."""
    csv.field_size_limit(LONGEST_FIELD)
    source = io.StringIO(text, newline="")
    named = separator(source.readline())
    if named is None:
        source.seek(0)
    rows = (r for r in csv.reader(source, delimiter=(named or sep)[:1]) if r)
    return next(rows, []), rows


class _Rows:
    """Records of one file after another, which go to Spark together."""

    def __init__(self):
        self.paths, self.places, self.heads, self.head, self.fields, self.chars = [], [], [], [], [], 0

    def put(self, path: str, names: list[str], first: int, rows: list[list[str]], chars: int) -> None:
        if not self.heads or self.heads[-1] != names:
            self.heads.append(names)
        self.paths += [path] * len(rows)
        self.places += range(first, first + len(rows))
        self.head += [len(self.heads) - 1] * len(rows)
        self.fields += rows
        self.chars += chars

    def full(self) -> bool:
        return len(self.fields) >= TOGETHER or self.chars >= CHARS

    def batch(self) -> pa.RecordBatch:
        strings = pa.list_(pa.string())
        names = pa.array(self.heads, strings).take(pa.array(self.head, pa.int64()))
        return pa.record_batch({"path": pa.array(self.paths, pa.string()), "idx": pa.array(self.places, pa.int64()), "names": names, "fields": pa.array(self.fields, strings)})


def _parse(batches: Iterator[pa.RecordBatch], sep: str, headers_only: bool) -> Iterator[pa.RecordBatch]:
    out = _Rows()
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            text = content.as_py().decode("utf-8-sig", "replace")
            header, rows = records(text, sep)
            places = {n: i for i, n in enumerate(header)}  # of columns with one name the last counts
            names, chosen = list(places), list(places.values())
            out.put(path, names, -1, [[""] * len(names)], len(text))
            at = 0
            while held := [] if headers_only else list(islice(rows, TOGETHER)):
                out.put(path, names, at, [[row[i] if i < len(row) else "" for i in chosen] for row in held], 0)
                at += len(held)
                if out.full():
                    yield out.batch()
                    out = _Rows()
            if out.full():
                yield out.batch()
                out = _Rows()
    if out.fields:
        yield out.batch()


def fields(spark: SparkSession, path: str | list[str], pattern: str = ".", sep: str = ",", headers_only: bool = False) -> DataFrame:
    """(path, idx, names, fields) of the files below ``path`` whose name matches: a row for each
    record, from 0, and one at -1 for each file, so that a file without records is told by its header.

    Short records are filled with '', longer ones cut.  A file is parsed by one task, which holds it whole: this is for
    files of bounded size, such as chunks.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # Spark puts some thirty small files into a task, whose start takes longer than they do.
    files = files.where(F.regexp_like("_metadata.file_name", F.lit(pattern))).select("path", "content").coalesce(tasks(spark))
    return files.mapInArrow(lambda batches: _parse(batches, sep, headers_only), _FIELDS)


def fields_of(paths: DataFrame, sep: str = ",") -> DataFrame:
    """:func:`fields` of the files in ``paths`` (path), opened by the tasks, so that only these are read."""

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, inner = store_of(path)
                with store.open_input_stream(inner) as f:
                    yield pa.record_batch({"path": [path], "content": [f.read()]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _parse(contents(batches), sep, False)

    return paths.select("path").repartition("path").mapInArrow(run, _FIELDS)


def open_rows(spark: SparkSession, path: str | list[str], pattern: str = RESULT_FILE, sep: str = ",") -> DataFrame:
    """(path, idx, row): each record as a VARIANT object, whatever the header of its file."""
    found = fields(spark, path, pattern, sep).where("idx >= 0")
    return found.select("path", "idx", F.to_variant_object(F.map_from_arrays("names", "fields")).alias("row"))


def merged_schema(rows: DataFrame, *by: str) -> DataFrame:
    """(by, schema): the one schema that holds all rows of a group, from one aggregation."""
    return rows.groupBy(*by).agg(F.schema_of_variant_agg("row").alias("schema"))


def _named(heads: DataFrame) -> list[str]:
    named = heads.select(F.posexplode("names").alias("at", "name")).groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name")
    return [r.name for r in named.toLocalIterator()]  # as many as there are columns, not files


def columns(spark: SparkSession, path: str | list[str], pattern: str = RESULT_FILE, sep: str = ",") -> list[str]:
    """The different columns of all files, by their first place in a header, then by name."""
    return _named(fields(spark, path, pattern, sep, headers_only=True))


def read_open(spark: SparkSession, path: str | list[str], pattern: str = RESULT_FILE, sep: str = ",") -> DataFrame:
    """``path`` and ``idx`` of each record, and the columns of all files as strings; '' where a
    file has no such column.

    Files are listed and opened once, as many small ones cost more than what is in them: records are kept in the shared folder.
    """
    kept = materialize(fields(spark, path, pattern, sep), "records")
    names = _named(kept.where("idx = -1"))
    found = kept.where("idx >= 0").withColumn("_row", F.map_from_arrays("names", "fields"))
    return found.select(F.col("path").alias("_path"), F.col("idx").alias("_idx"), *[F.coalesce(F.try_element_at("_row", F.lit(n)), F.lit("")).alias(n) for n in names])
