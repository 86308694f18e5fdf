"""Results that came in overlapping ranges: which one counts at each index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunklake.operators.merge import gaps
from chunklake.sources.shared import tasks

#: Rows that go to Spark at once.
TOGETHER = 4096


def sweep(spans: list[tuple[int, int, tuple]]) -> list[tuple[int, int, tuple]]:
    """(first, last, priority) of the least priority that covers each index, in order.

    ``spans`` are (first, last, priority), both ends inclusive.  Spans that are open at a
    place are in a heap; one that has ended leaves it when it comes to the top.
    """
    spans = sorted(spans)
    ends = sorted({s for s, _, _ in spans} | {e + 1 for _, e, _ in spans})
    found: list[tuple[int, int, tuple]] = []
    heap: list[tuple[tuple, int]] = []
    at = 0
    for a, b in zip(ends, ends[1:], strict=False):
        while at < len(spans) and spans[at][0] <= a:
            heapq.heappush(heap, (spans[at][2], spans[at][1]))
            at += 1
        while heap and heap[0][1] < a:
            heapq.heappop(heap)
        if not heap:
            continue
        best = heap[0][0]
        if found and found[-1][2] == best and found[-1][1] == a - 1:
            found[-1] = (found[-1][0], b - 1, best)
        else:
            found.append((a, b - 1, best))
    return found


def choose(fragments: DataFrame, *keys: str) -> DataFrame:
    """(keys, file, first, last): the ranges of indices for which each fragment counts.

    ``fragments`` has keys, file, start and end (inclusive, by its name) and ``rows``, those it has.  A fragment
    with as many rows as its name says is complete; one with fewer covers as many from its start on; one with more covers its
    range and is incomplete too.  At an index a complete fragment counts before an incomplete one, a narrower
    before a wider one, then one that starts earlier, then by the file's name.  A chunk's
    fragments are swept in one task; there are at most some for each row of the chunk.
    """
    held = fragments.where("rows > 0 and `end` >= start").select(*keys, "file", "start", "end", "rows")
    kinds = {f.name: f.dataType.simpleString() for f in held.schema.fields}

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's chunks, one after another as they come sorted."""
        types: list[pa.DataType] = []

        def rows() -> Iterator[tuple]:
            for batch in batches:
                types[:] = batch.schema.types[: len(keys)]
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        def table(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, [*types, pa.string(), pa.int64(), pa.int64()], strict=True)], names=[*keys, "file", "first", "last"])

        out: list[tuple] = []
        for key, some in groupby(rows(), lambda r: r[: len(keys)]):
            spans = []
            for file, start, end, n in (r[len(keys) :] for r in some):
                width = end - start + 1
                spans.append((start, start + min(n, width) - 1, (n != width, width, start, file)))
            out += [(*key, p[3], a, b) for a, b, p in sweep(spans)]
            if len(out) >= TOGETHER:
                yield table(out)
                out = []
        if out:
            yield table(out)

    dealt = held.repartition(tasks(held.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(swept, ", ".join([f"`{k}` {kinds[k]}" for k in keys] + ["file string", "first long", "last long"]))


def merge_fragments(rows: DataFrame, *keys: str) -> DataFrame:
    """Of ``rows`` (keys, file, start, end, idx and results) those of the fragment that counts at their index.

    Each index has one row at most.
    """
    counted = rows.groupBy(*keys, "file", "start", "end").agg(F.count("*").alias("rows"))
    chosen = choose(counted, *keys)
    return rows.join(chosen, [*keys, "file"]).where("idx between first and last").drop("first", "last")


def fragment_gaps(rows: DataFrame, sizes: DataFrame, *keys: str) -> DataFrame:
    """(keys, start, end) of what no fragment covers; ``sizes`` has keys and ``size``."""
    counted = rows.groupBy(*keys, "file", "start", "end").agg(F.count("*").alias("rows"))
    return gaps(choose(counted, *keys).select(*keys, F.col("first").alias("start"), F.col("last").alias("end")), sizes, *keys)
