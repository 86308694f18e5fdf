"""Rows of delimited text inside zip, gzip and bz2 archives, as a Python data source."""

from __future__ import annotations

import bz2
import csv
import gzip
import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from chunklake.operators.columns import extract, resolve
from chunklake.sources.chunk_sink import store_of
from chunklake.sources.text_files import read_csv

LONGEST_FIELD = 10485760
#: Rows of a member that go to Spark at once.
TOGETHER = 8192


@dataclass(frozen=True)
class Layout:
    """How an archive holds its rows.

    members: 'largest' (the largest file with a suffix of ``suffixes``), 'each'
    (all of them, by name, each with its header) or 'whole' (one file, plain, bz2 or gzip).
    """

    members: str
    delimiter: str
    structure: str
    identifier: str
    suffixes: tuple[str, ...] = (".csv", ".tsv", ".txt", ".smi", ".smiles")


@dataclass
class _Member(InputPartition):
    path: str
    name: str
    number: int


def candidates(infos: list, suffixes: tuple[str, ...]) -> list:
    return [i for i in infos if not i.is_dir() and not i.filename.startswith("__MACOSX") and i.filename.lower().endswith(suffixes)]


def _file(path: str):
    """A seekable file, local or behind a URI that Arrow knows."""
    store, inner = store_of(path)
    return store.open_input_file(inner)


def _open(part: _Member) -> Iterator[str]:
    file = _file(part.path)
    if not part.name:
        raw = bz2.open(file) if part.path.endswith(".bz2") else gzip.open(file) if part.path.endswith(".gz") else file
    else:
        raw = zipfile.ZipFile(file).open(part.name)
        raw = gzip.open(raw) if part.name.endswith(".gz") else raw
    return io.TextIOWrapper(raw, "utf-8-sig", errors="replace", newline="")


def _lines(text: io.TextIOBase) -> Iterator[str]:
    first = next(iter(text), "")
    if not first.strip().lower().startswith("sep="):
        yield first
    yield from text


def members(path: str, layout: Layout) -> list[_Member]:
    """The members of an archive that hold its rows, in their order."""
    if layout.members == "whole":
        return [_Member(path, "", 0)]
    with _file(path) as file, zipfile.ZipFile(file) as z:
        found = candidates(z.infolist(), layout.suffixes)
    if layout.members == "largest":
        found = [max(found, key=lambda i: i.file_size)] if found else []
    else:
        found.sort(key=lambda i: i.filename)
    return [_Member(path, i.filename, n) for n, i in enumerate(found)]


def rows(part: _Member, layout: Layout) -> Iterator[pa.RecordBatch]:
    """The rows of a member that have a structure, some thousands at once."""
    csv.field_size_limit(LONGEST_FIELD)
    with _open(part) as text:
        found = csv.reader(_lines(text), delimiter=layout.delimiter)
        header = next(found, [])
        s = resolve(header, layout.structure)
        if s is None:
            return
        i = resolve(header, layout.identifier)
        at, by = header.index(s), header.index(i) if i else None
        numbered = enumerate(r for r in found if r)
        while some := list(islice(numbered, TOGETHER)):
            held = [(v, r[by].strip() if by is not None and by < len(r) else "", n) for n, r in some if at < len(r) and (v := r[at].strip())]
            if held:
                values, ids, places = (list(c) for c in zip(*held, strict=True))
                yield pa.record_batch({"smiles": pa.array(values, pa.string()), "collection_id": pa.array(ids, pa.string()), "member": pa.array([part.number] * len(held), pa.int32()), "row": pa.array(places, pa.int64())})


def archives_of(paths: DataFrame, layout: Layout) -> DataFrame:
    """(path, smiles, collection_id, member, row) of the archives in ``paths`` (path), each read by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for part in members(path, layout):
                    for found in rows(part, layout):
                        yield found.add_column(0, "path", pa.array([path] * len(found), pa.string()))

    return paths.select("path").repartition("path").mapInArrow(run, "path string, smiles string, collection_id string, member int, row long")


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.layout = Layout(options["members"], options["delimiter"], options["structure"], options["identifier"], tuple(options["suffixes"].split("|")))

    def partitions(self):
        return members(self.path, self.layout)

    def read(self, partition):
        return rows(partition, self.layout)


class ArchiveSource(DataSource):
    """format("archive"): (smiles, collection_id, member, row), the last two in the archive's order."""

    @classmethod
    def name(cls):
        return "archive"

    def schema(self):
        return "smiles string, collection_id string, member int, row long"

    def reader(self, schema):
        return ArchiveReader(dict(self.options))


def read_archive(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """Rows with a structure, stripped; one task for each member.  ``path`` is local to all
    machines or a URI that Arrow opens.  A bz2 file that stands alone is read by Spark in
    blocks, in as many tasks as it has splits; there ``row`` ascends in the file's order, with gaps, and a quoted
    value may hold no line end."""
    if layout.members == "whole" and path.endswith(".bz2"):
        lines = read_csv(spark, path, layout.delimiter, multiLine=False)
        return extract(lines, layout.structure, layout.identifier, F.lit(0).alias("member"), F.monotonically_increasing_id().alias("row"))
    spark.dataSource.register(ArchiveSource)
    options = {"members": layout.members, "delimiter": layout.delimiter, "structure": layout.structure, "identifier": layout.identifier, "suffixes": "|".join(layout.suffixes)}
    return spark.read.format("archive").options(**options).option("path", path).load()
