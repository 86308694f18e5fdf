"""Results of a model kept up to date with the chunks they were made from."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.operators.models import score_spread
from chunklake.operators.reconcile import fingerprint, validity
from chunklake.operators.runners import Model
from chunklake.sources.published import current, newest, publish
from chunklake.sources.shared import materialize

_MARKS = "n long, sum decimal(38,0), xor long, load string"


def _state(chunked: DataFrame, target: str, keys: tuple[str, ...]) -> DataFrame:
    """The published state: of each chunk with results, the fingerprint of its inputs and the load they are in."""
    named = ", ".join(f"`{k}` {chunked.schema[k].dataType.simpleString()}" for k in keys)
    return current(chunked.sparkSession, f"{target}/chunks", f"{named}, {_MARKS}")


def due(chunked: DataFrame, target: str, value: str, keys: tuple[str, ...] = ("chunk_no",), carry: tuple[str, ...] = ()) -> DataFrame:
    """(keys, status) of all chunks: VALID, STALE, MISSING or ORPHANED, by their inputs as they are now and as
    they were when their results were made.  A row's place counts, its order in the table does not."""
    return validity(fingerprint(chunked, ["idx", value, *carry], *keys), _state(chunked, target, keys), *keys)


def bring_up_to_date(
    chunked: DataFrame, target: str, value: str, model: Model, columns: list[str], keys: tuple[str, ...] = ("chunk_no",), carry: tuple[str, ...] = (), fanout: int = 10, seconds: float | None = None
) -> dict[str, int]:
    """Run ``model`` on the chunks whose results in ``target`` are missing or stale; returns how many chunks had which status.

    Chunks with valid results are not run.  Results are written under the name of this load, and the state, which
    says in which load each chunk's results are, is then published as a whole: readers see all results of this run or none, a run
    that ends before has changed nothing, and results of chunks that there are no more go.  Of two runs at once one gets Conflict.
    Failing rows are isolated as in :func:`score_spread`; a chunk with failed rows has its results too, and is not due again
    until its inputs change.
    """
    spark, load = chunked.sparkSession, f"load-{uuid.uuid4().hex}"
    seen = newest(spark, f"{target}/chunks")
    # Read once: what is told, run and published is of the same inputs.
    rows = materialize(chunked.select(*keys, "idx", value, *carry), "inputs")
    now = materialize(fingerprint(rows, ["idx", value, *carry], *keys), "fingerprints")
    held = _state(chunked, target, keys)
    status = materialize(validity(now, held, *keys), "validity")
    counts = {"VALID": 0, "STALE": 0, "MISSING": 0, "ORPHANED": 0} | {r.status: r["count"] for r in status.groupBy("status").count().collect()}  # four at most
    if seen is None or counts["STALE"] + counts["MISSING"] + counts["ORPHANED"]:
        fresh = status.where(F.col("status").isin("STALE", "MISSING")).select(*keys)
        scored, _ = score_spread(rows.join(fresh, list(keys), "left_semi"), value, model, columns, keys, fanout, seconds, carry)
        scored.write.parquet(f"{target}/rows/_load={load}")
        valid = held.join(status.where("status = 'VALID'").select(*keys), list(keys), "left_semi")
        made = now.join(fresh, list(keys), "left_semi").withColumn("load", F.lit(load))
        publish(valid.unionByName(made), f"{target}/chunks", expect=seen["version"] if seen else 0)
    return counts


def results(spark: SparkSession, target: str, keys: tuple[str, ...] = ("chunk_no",)) -> DataFrame:
    """The results of all chunks as last published, one row for each row of theirs."""
    state = current(spark, f"{target}/chunks").select(*keys, F.col("load").alias("_load"))
    return spark.read.parquet(f"{target}/rows").join(state, [*keys, "_load"], "left_semi").drop("_load")
