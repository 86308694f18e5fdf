"""Vector codes by product quantisation with VA-file filtering (operator 12).

A vector's integer components are cut into parts; each part becomes the index of
the nearest entry of its codebook.  The nearest entry is found as in a VA-file:
entries' coordinates are cut into cells of a few bits, a query part gets a table
of the least and the largest squared distance to each cell, sums of table values
bound each entry's distance from below and above, and only entries whose lower
bound does not exceed the least upper bound are compared by integer distances.

Spark deals the vectors out; a task keeps a codebook, blocks of bounded size and
one sum for each entry.  What comes to the driver is the codebook, whose size
depends on the number of entries and the dimension alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.llm.common import materialize, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Bits of a cell, and table values that a block of queries may have.
BITS, BLOCK = 4, 1 << 22
#: Integers are held to this size on either side, so that all sums fit into 64 bits.
LARGEST = 1 << 24

Codebooks = list[np.ndarray]


class Cells:
    """One part's entries with their coordinates in cells.

    A dimension's cells hold about as many entries each and are known by the least and the
    largest coordinate in them, so that bounds are as tight as the cells allow.
    """

    def __init__(self, entries: np.ndarray, bits: int = BITS):
        self.entries = entries = entries.astype(np.int64)
        k, self.width = entries.shape
        self.reach = int(np.abs(entries).max(initial=0))
        count = min(1 << bits, k)
        order = np.argsort(entries, axis=0, kind="stable")
        ranked = np.take_along_axis(entries, order, 0)
        starts = -(-np.arange(count) * k // count)
        self.low, self.high = ranked[starts].T, ranked[np.append(starts[1:], k) - 1].T  # dimension, cell
        self.cell = np.empty((k, self.width), np.int64)
        np.put_along_axis(self.cell, order, np.repeat(np.arange(count), np.diff(np.append(starts, k)))[:, None], 0)

    def _bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(queries, entries): squared distances are at least and at most this."""
        # In 32 bits where no sum can be larger.
        reach = int(np.abs(queries).max(initial=0)) + self.reach
        kind = np.int32 if reach * reach * self.width < 1 << 31 else np.int64
        queries, low, high = (x.astype(kind) for x in (queries, self.low, self.high))
        below, above = low[None] - queries[:, :, None], queries[:, :, None] - high[None]
        least = np.maximum(np.maximum(below, above), 0) ** 2
        most = np.maximum(-below, -above) ** 2
        lower, upper = (np.zeros((len(queries), len(self.entries)), kind) for _ in range(2))
        for d in range(self.width):
            lower += least[:, d].take(self.cell[:, d], 1)
            upper += most[:, d].take(self.cell[:, d], 1)
        return lower, upper

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest entry of each query, ties to the lower index, its squared distance, and
        how many pairs had to be compared."""
        found, error, pairs = np.empty(len(queries), np.int64), np.empty(len(queries), np.int64), 0
        step = max(1, BLOCK // (len(self.entries) * self.width))
        for a in range(0, len(queries), step):
            block = queries[a : a + step].astype(np.int64)
            lower, upper = self._bounds(block)
            row, entry = np.nonzero(lower <= upper.min(1)[:, None])
            exact = ((block[row] - self.entries[entry]) ** 2).sum(1)
            starts = np.searchsorted(row, np.arange(len(block)))
            best = np.minimum.reduceat(exact, starts)
            hit = np.flatnonzero(exact == best[row])
            first = hit[np.searchsorted(row[hit], np.arange(len(block)))]
            found[a : a + step], error[a : a + step] = entry[first], best
            pairs += len(row)
        return found, error, pairs


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if len(batch):
            yield batch, batch.column("ints").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(batch), width)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, ints): floor(1024 * x) of the rows whose vector is not null, not empty and
    holds only finite components; integers are held to 2^24 on either side."""
    held = F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    held &= F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(F.least(F.greatest(x.cast("double") * SCALE, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))).cast("int"))
    return vectors.where(held).select(F.col("vec_id").cast("long").alias("vec_id"), "label", scaled.alias("ints"))


def _cut(width: int, parts: int) -> list[tuple[int, int]]:
    """Where consecutive parts begin and end; if they can't be equal, the first ones are longer."""
    ends = np.cumsum([len(x) for x in np.array_split(np.arange(width), parts)]).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def _sums(ints: DataFrame, books: Codebooks, cuts: list[tuple[int, int]]) -> DataFrame:
    """(part, entry, position, total, n): each task's sums of the parts at an entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b) for b in books]
        totals, counts = [np.zeros(b.shape, np.int64) for b in books], [np.zeros(len(b), np.int64) for b in books]
        for _, x in _batches(batches, cuts[-1][1]):
            for p, (a, b) in enumerate(cuts):
                near = cells[p].nearest(x[:, a:b])[0]
                np.add.at(totals[p], near, x[:, a:b])
                counts[p] += np.bincount(near, minlength=len(counts[p]))
        for p, (total, count) in enumerate(zip(totals, counts, strict=True)):
            entry, position = np.nonzero(np.broadcast_to(count[:, None] > 0, total.shape))
            if len(entry):
                yield pa.record_batch({"part": np.full(len(entry), p, np.int32), "entry": entry.astype(np.int32), "position": position.astype(np.int32), "total": total[entry, position], "n": count[entry]})

    return ints.mapInArrow(run, "part int, entry int, position int, total long, n long")


def train(ints: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """The codebook of each part after ``rounds`` of assigning all rows and averaging.

    Entries begin as the parts of the rows of the ``entries`` least vec_ids (null ids last,
    repeated ids by their vectors); averages are rounded down and unused entries stay.
    """
    seeds = ints.select("vec_id", "ints").orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
    first, cuts = np.array([r.ints for r in seeds], np.int64).reshape(len(seeds), width), _cut(width, parts)
    books = [first[:, a:b].copy() for a, b in cuts]
    for _ in range(rounds):
        sums = _sums(ints, books, cuts).groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        books = [b.copy() for b in books]
        for r in sums.toLocalIterator():  # one row for each number of the codebooks
            books[r.part][r.entry, r.position] = r.total // r.n
    return books


def fingerprint(books: Codebooks) -> str:
    """SHA-256 of the entries' components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def encode(ints: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error, compared): the indexes in order of the parts, the squared
    distances summed over parts, and how many entries had to be compared with the row by all components."""
    cuts = list(zip(np.cumsum([0, *[b.shape[1] for b in books[:-1]]]).tolist(), np.cumsum([b.shape[1] for b in books]).tolist(), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b) for b in books]
        for batch, x in _batches(batches, cuts[-1][1]):
            codes, errors, pairs = [], np.zeros(len(x), np.int64), 0
            for c, (a, b) in zip(cells, cuts, strict=True):
                near, error, compared = c.nearest(x[:, a:b])
                codes.append(near)
                errors += error
                pairs += compared
            columns = {"vec_id": batch.column("vec_id"), "label": batch.column("label"), "code": pa.array(np.stack(codes, 1).astype(np.int32).tolist(), pa.list_(pa.int32()))}
            yield pa.record_batch(columns | {"error": errors, "compared": np.full(len(x), pairs / len(x))})

    return ints.mapInArrow(run, f"vec_id long, label {ints.schema['label'].dataType.simpleString()}, code array<int>, error long, compared double")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """:func:`encode` over ``vectors`` (vec_id, embedding, label), and the codebooks trained on all of them.

    Null and empty vectors and those with a null or non-finite component take no part, nor do
    vectors of another length than that of the least vec_id's.  Rows that share a vec_id, and rows
    without one, are rows each; other columns are left out.  No usable row: no result and no codebook.
    """
    ints = materialize(usable(vectors), "ints")
    first = ints.orderBy(F.col("vec_id").asc_nulls_last(), "ints").select(F.size("ints").alias("n")).first()
    if first is None:
        return ints.select("vec_id", "label", F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error"), F.lit(None).cast("double").alias("compared")), []
    ints = ints.where(F.size("ints") == first.n)
    books = train(ints, first.n, min(parts, first.n), entries, rounds)
    return encode(ints, books), books


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the errors summed over equal labels, nulls together.

    Errors are summed before labels meet their rows, so that a label with most rows is no task's alone.
    """
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    digits = F.array_join(F.transform("code", lambda i: F.lower(F.lpad(F.hex(i), 2, "0"))), "")
    rows = label_errors(materialize(coded, "codes"))
    return rows.select("vec_id", digits.alias("code"), "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """All distances to all entries, round by round; vectors of 64 components."""
    near = """a{i} AS MATERIALIZED (SELECT vec_id, p, any_value(x) AS x, min((list_inner_product(x, x) + list_inner_product(e, e) - 2 * list_inner_product(x, e))::BIGINT * 256 + k) AS m FROM q JOIN c{i} USING (p) GROUP BY vec_id, p)"""
    move = """c{j} AS MATERIALIZED (SELECT c.p, c.k, coalesce(n.e, c.e) AS e FROM c{i} c LEFT JOIN (SELECT p, k, list(floor(s / n) ORDER BY i) AS e
FROM (SELECT p, m % 256 AS k, i, sum(x[i]) AS s, count(*) AS n FROM a{i}, range(1, 17) t(i) GROUP BY ALL) GROUP BY p, k) n ON n.p = c.p AND n.k = c.k)"""
    steps = ",\n".join(near.format(i=i) + (",\n" + move.format(i=i, j=i + 1) if i < ROUNDS else "") for i in range(ROUNDS + 1))
    return f"""
WITH v AS (SELECT vec_id, label, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
q AS MATERIALIZED (SELECT vec_id, label, p::INT AS p, v[p * 16 + 1 : p * 16 + 16] AS x FROM v, range(4) t(p)),
c0 AS MATERIALIZED (SELECT p, k, x AS e FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k FROM q) WHERE k < 256),
{steps},
r AS (SELECT vec_id, string_agg(format('{{:02x}}', m % 256), '' ORDER BY p) AS code, sum(m // 256)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
(SELECT sha256(string_agg(array_to_string([x::BIGINT FOR x IN e], ','), ',' ORDER BY p, k)) FROM c{ROUNDS}) AS codebooks_sha256 FROM r JOIN v USING (vec_id)
"""


QUERIES = {"op12_vector_codes": op12_vector_codes}
ORACLE_SQL = {"op12_vector_codes": _sql()}
