"""Lempel-Ziv phrase fingerprints of documents (operator 10).

A text is parsed by LZ78: the next phrase is the longest known phrase and one
more unit, where a unit is a word (at most 16 characters of one) with the blanks
before it.  A phrase's hash is that of its last unit seeded with the hash of the
phrase it extends, so parsing takes one hash for each unit.  The fingerprint is a
one-permutation minimum-hash signature of the set of phrases: of 128 equal
ranges of hashes, eight bits of the least in each.  The share of equal bytes,
less chance, estimates the share of phrases two texts have in common.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunklake.llm.common import materialize, table, texts

BINS = 128

_UNITS = re.compile(r"\s*\S{1,16}|\s+")


def phrases(text: str) -> set[int]:
    """Hashes of the LZ78 phrases of ``text``."""
    seen: set[int] = set()
    digest, at = xxhash.xxh64_intdigest, 0
    units = _UNITS.findall(text) if len(text) < 10_000_000 else (m.group() for m in _UNITS.finditer(text))
    for unit in units:
        at = digest(unit, at)
        if at not in seen:
            seen.add(at)
            at = 0
    return seen


def signature(found: set[int]) -> bytes:
    """128 bytes: the low bits of the least hash of each range; an empty range
    borrows from the next that is not, marked by the distance.  No phrase: zeros."""
    if not found:
        return bytes(BINS)
    h = np.sort(np.fromiter(found, np.uint64, len(found)))
    bins, first = np.unique((h >> np.uint64(57)).astype(np.int64), return_index=True)
    low = (h[first] & np.uint64(255)).astype(np.int64)
    at = np.searchsorted(bins, np.arange(BINS))
    away = (bins[at % len(bins)] - np.arange(BINS)) % BINS
    return ((low[at % len(bins)] + 37 * away) & 255).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    same = float((np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)).mean())
    return max(0.0, (same - 1 / 256) / (1 - 1 / 256))


def fingerprint(text: str | None) -> str:
    return signature(phrases(text or "")).hex()


def edited(text: str, following: str) -> str:
    """``text`` whose last quarter is replaced by as much of the next document's start."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_PENDING = f"{_RESULT}, part long, head string, tail string, empty boolean"


def _row(doc: int | None, text: str, sign: bytes, following: str, next_sign: bytes) -> tuple:
    new = edited(text, following)
    new_sign = sign if new == text else signature(phrases(new))
    return doc, len(text), hashlib.sha256(new.encode()).hexdigest(), sign.hex(), new_sign.hex(), likeness(sign, new_sign), likeness(sign, next_sign)


def _batch(rows: list[tuple], fields: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    named = [f.split() for f in fields.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), named, strict=True)], [n for n, _ in named])


def _sorted_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition in order; its first and last text go out for its neighbours."""
    part, head, last, rows = TaskContext.get().partitionId(), None, None, []
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            sign = signature(phrases(text))
            if last is None:
                head = text
            else:
                rows.append((*_row(*last, text, sign), part, None, None, False))
            last = (doc, text, sign)
            if len(rows) >= 512:
                yield _batch(rows, _PENDING)
                rows = []
    if last is not None:
        rows.append((last[0], None, None, None, None, None, None, part, head, last[1], True))
        yield _batch(rows, _PENDING)


def _stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_row(d, t, signature(phrases(t)), f, signature(phrases(f))) for d, t, f in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tail", "following")), strict=True)]
        if rows:
            yield _batch(rows, _RESULT)


def compare(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: its fingerprint, its edited text's, and their likeness.

    The next document is that with the next greater id (ties: by a hash of the
    text; null ids come last; after the last: the first).  Null texts are empty.
    Documents are sorted over all partitions, rows that share an id or have none
    as well, and read as a stream.  Only the ends of partitions meet in a second
    step: which partition follows which is found on their numbers alone, and a
    join then brings the two texts together.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.col("_hash"), F.col("_place")]
    # _place only tells equal rows apart, so that they can be dealt to several partitions.
    placed = texts(docs).withColumn("_hash", F.xxhash64("text")).withColumn("_place", F.monotonically_increasing_id())
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    run = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    run = materialize(run.mapInArrow(_sorted_run, _PENDING), "lz-runs")
    ends = run.where("empty")
    w = Window.orderBy("part")
    # One row of one number for each partition.
    follows = ends.select("part").withColumn("next_part", F.coalesce(F.lead("part").over(w), F.first("part").over(w)))
    heads = ends.select(F.col("part").alias("next_part"), F.col("head").alias("following"))
    stitched = ends.select("doc_id", "part", "tail").join(follows, "part").join(heads, "next_part").select("doc_id", "tail", "following").mapInArrow(_stitched, _RESULT)
    names = [f.split()[0] for f in _RESULT.split(", ")]
    return run.where("not empty").select(*names).union(stitched)


def op10_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare(table(spark, sf_dir, "documents"))


QUERIES = {"op10_lz_fingerprint": op10_lz_fingerprint}
ORACLE_SQL: dict[str, str] = {}
