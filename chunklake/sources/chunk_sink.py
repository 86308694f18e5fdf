"""CSV files with names of their own, written by the tasks and committed as a whole: ``format("chunks")``."""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow.fs import FileSystem, FileType
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from chunklake.sources.shared import tasks


def store_of(path: str) -> tuple[FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return FileSystem.from_uri(path if "://" in path else f"file://{path}")


def _there(store: FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != FileType.NotFound


def _move(store: FileSystem, source: str, target: str) -> None:
    """Rename over what is there; some stores refuse that."""
    try:
        store.move(source, target)
    except OSError:
        if not _there(store, target):
            raise
        store.delete_file(target)
        store.move(source, target)


@dataclass
class Written(WriterCommitMessage):
    files: int
    rows: int


class _Files:
    """The files of one task, one after another, each under a hidden name until it is whole."""

    def __init__(self, folder: str, header: list[str]):
        self.store, self.folder = store_of(folder)
        self.header, self.name, self.inner = header, None, None
        self.files = self.rows = 0

    def put(self, name: str, columns: list[list]) -> None:
        if name != self.name:
            self.close()
            inner, _, last = f"{self.folder}/{name}".rpartition("/")
            if inner != self.inner:
                self.store.create_dir(inner, recursive=True)
                self.inner = inner
            self.temporary = f"{inner}/.{last}-{uuid.uuid4().hex}"
            self.raw = self.store.open_output_stream(self.temporary, compression=None)
            self.text = io.TextIOWrapper(self.raw, "utf-8", errors="replace", newline="")
            self.csv = csv.writer(self.text)
            self.csv.writerow(self.header)
            self.name = name
        self.csv.writerows(zip(*columns, strict=True))
        self.rows += len(columns[0])

    def close(self) -> None:
        if self.name is not None:
            self.text.close()
            _move(self.store, self.temporary, f"{self.folder}/{self.name}")
            self.files += 1
            self.name = None

    def drop(self) -> None:
        if self.name is not None:
            self.raw.close()
            self.store.delete_file(self.temporary)


class ChunkWriter(DataSourceArrowWriter):
    """Each task writes whole files, whose rows come to it sorted; a repeated task writes the same files again.

    With ``overwrite`` all files go to a folder beside the target, which takes the target's
    place on commit, or goes on abort.  Otherwise each file appears in the target once it is whole.  The
    manifest, written last, has the numbers of files and rows of the export.
    """

    def __init__(self, options: dict, columns: list[str], overwrite: bool):
        self.target, self.label = options["path"].rstrip("/"), options["label"]
        self.header, self.overwrite = columns[2:], overwrite
        self.folder = f"{self.target}.writing-{uuid.uuid4().hex}" if overwrite else self.target

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files = _Files(self.folder, self.header)
        try:
            for batch in iterator:
                names, indexed = batch.column(0).to_pylist(), batch.column(1).is_valid().to_pylist()
                columns = [c.to_pylist() for c in batch.columns[2:]]
                at = 0
                while at < len(names):
                    end = at + 1
                    while end < len(names) and names[end] == names[at] and indexed[end] == indexed[at]:
                        end += 1
                    # A row without a place only says that there is such a file.
                    files.put(names[at], [c[at:end] if indexed[at] else [] for c in columns])
                    at = end
            files.close()
        except BaseException:
            files.drop()
            raise
        return Written(files.files, files.rows)

    def commit(self, messages: list) -> None:
        done = [m for m in messages if m is not None]
        store, folder = store_of(self.folder)
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/_manifest-{self.label}.json") as out:
            out.write(json.dumps({"label": self.label, "files": sum(m.files for m in done), "rows": sum(m.rows for m in done)}).encode())
        if self.overwrite:
            _, target = store_of(self.target)
            if _there(store, target):
                store.move(target, f"{folder}.old")
            store.move(folder, target)
            if _there(store, f"{folder}.old"):
                store.delete_dir(f"{folder}.old")

    def abort(self, messages: list) -> None:
        store, folder = store_of(self.folder)
        if self.overwrite and _there(store, folder):
            store.delete_dir(folder)


class ChunkSink(DataSource):
    """format("chunks"), for writing: a file's name, the place of a row in it, and its columns as strings."""

    @classmethod
    def name(cls):
        return "chunks"

    def writer(self, schema, overwrite):
        return ChunkWriter(dict(self.options), schema.names, overwrite)


def export_files(rows: DataFrame, path: str, label: str, name: Column, order: str, *columns: str, headers: DataFrame | None = None, replace: bool = False) -> None:
    """``columns`` of ``rows`` in files below ``path``, named by ``name`` (which may hold folders), in ``order``.

    Files are those of the csv module: CRLF, doubled quotes, an empty value quoted where it stands
    alone; null is ''.  Files of ``headers``, by the same ``name``, that have no rows hold the header alone.  Tasks write,
    name and complete the files; the driver only commits, and the manifest ``_manifest-<label>.json`` says that it has.  With
    ``replace`` the folder holds this export alone afterwards, and its former content until then; otherwise
    files of other names stay.  A file's rows are in one task.  No rows: a manifest alone.
    """
    out = rows.select(name.alias("_file"), F.coalesce(F.col(order).cast("long"), F.lit(0)).alias("_place"), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in columns])
    if headers is not None:
        out = out.union(headers.select(name.alias("_file")).distinct().select("_file", F.lit(None).cast("long"), *[F.lit("") for _ in columns]))
    rows.sparkSession.dataSource.register(ChunkSink)
    placed = out.repartition(tasks(rows.sparkSession), "_file").sortWithinPartitions("_file", F.col("_place").asc_nulls_first())
    placed.write.format("chunks").mode("overwrite" if replace else "append").option("path", path).option("label", label).save()


def export_chunks(chunked: DataFrame, path: str, library: str, *columns: str, labels: DataFrame | None = None, replace: bool = False) -> None:
    """Files ``<library>_chunk_NNN.csv``, with rows in the order of ``idx``; see :func:`export_files`.

    Chunks of ``labels`` (chunk_no) without rows get a file with the header alone.
    """
    name = F.format_string("%s_chunk_%03d.csv", F.lit(library), F.col("chunk_no").cast("int"))
    export_files(chunked, path, library, name, "idx", *columns, headers=labels, replace=replace)


def manifest(path: str, label: str) -> dict | None:
    """What the last export of ``label`` into ``path`` has written; None before its commit."""
    store, folder = store_of(path)
    name = f"{folder.rstrip('/')}/_manifest-{label}.json"
    if not _there(store, name):
        return None
    with store.open_input_stream(name) as f:
        return json.loads(f.read())
