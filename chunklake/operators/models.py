"""Batch models over chunks, with failing rows isolated in a chunk's task or over the cluster."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunklake.functions.text import blank
from chunklake.operators.runners import Model, Trial, trials
from chunklake.sources.shared import drop, materialize

OK, FAIL, SKIP, UNREPRODUCED = "OK", "FAIL", "SKIP", "UNREPRODUCED"
#: A range of several rows that failed and is split in the next round.
SPLIT = "SPLIT"
#: Tasks of a round for each core, at most: enough to even out ranges that take long, and few where they don't.
TASKS = 3


def texts(out: pd.DataFrame, column: str) -> list[str]:
    """A model's results in one of the declared columns, as strings; what is missing is ''."""
    if column not in out.columns:
        return [""] * len(out)
    return ["" if gone else str(v) for v, gone in zip(out[column].tolist(), out[column].isna().tolist(), strict=True)]


def as_text(out: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    """A model's results in all declared columns."""
    return pd.DataFrame({c: texts(out, c) for c in columns}, index=out.index, dtype=object)


def isolate(model: Model, values: list[str], columns: list[str], fanout: int = 10, seconds: float | None = None) -> pd.DataFrame:
    """A row for each value: results, ``status`` and ``details``; failing rows are padded.

    A batch that fails is split into ``fanout`` parts, again and again, to the rows
    that fail alone.  If it fails and each of its parts passes, they are UNREPRODUCED.
    ``seconds`` limits each trial.
    """

    def run(trial: Trial, at: int, end: int) -> Iterator[tuple[int, pd.DataFrame, str, str]]:
        out, why = trial(values[at:end])
        if out is not None:
            yield at, out, OK, ""
        elif end - at == 1:
            yield at, pd.DataFrame([dict.fromkeys(columns, "")]), FAIL, why
        else:
            step = -(-(end - at) // min(fanout, end - at))
            parts = [p for i in range(at, end, step) for p in run(trial, i, min(i + step, end))]
            alone = all(p[2] == OK for p in parts)
            yield from ((i, o, UNREPRODUCED if alone else s, why if alone else w) for i, o, s, w in parts)

    blank = [i for i, v in enumerate(values) if not (v or "").strip()]
    live = [i for i, v in enumerate(values) if (v or "").strip()]
    everything, values = values, [values[i] for i in live]
    with trials(model, seconds) as trial:
        frames = [as_text(o, columns).assign(status=s, details=w, place=live[i : i + len(o)]) for i, o, s, w in (run(trial, 0, len(values)) if values else ())]
    if blank:
        frames.append(pd.DataFrame([dict.fromkeys(columns, "")] * len(blank)).assign(status=SKIP, details="empty", place=blank))
    if not frames:
        return pd.DataFrame(columns=[*columns, "status", "details"])
    return pd.concat(frames).sort_values("place").drop(columns="place").reset_index(drop=True).iloc[: len(everything)]


def _schema(df: DataFrame, *more: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + list(more))


def score(chunked: DataFrame, value: str, model: Model, columns: list[str], keys: tuple[str, ...] = ("chunk_no",), fanout: int = 10, seconds: float | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Run ``model`` once for each chunk, which has a bounded number of rows.

    Returns ``keys``, ``idx``, ``value``, the columns ``carry`` as they are, the model's ``columns`` as strings,
    ``status`` and ``details``, in declared columns whatever the model returns.  A chunk's failing
    rows are isolated in its task: :func:`score_spread` does that over all tasks.
    """
    rows = chunked.select(*keys, "idx", value, *carry)

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("idx").reset_index(drop=True)
        return pd.concat([frame, isolate(model, frame[value].fillna("").tolist(), columns, fanout, seconds)], axis=1)

    return rows.groupBy(*keys).applyInPandas(one, _schema(rows, *[f"`{c}` string" for c in (*columns, "status", "details")]))


def _try_ranges(work: DataFrame, ranges: int, value: str, model: Model, columns: list[str], keys: tuple[str, ...], seconds: float | None) -> DataFrame:
    """Each range of ``work`` (keys, _start, _end) run once; ranges are dealt out over all cores."""
    spark = work.sparkSession

    names = [f.name for f in work.schema.fields]

    def tried(table: pa.Table, firsts: list[int], trial: Trial, task: int) -> Iterator[pa.RecordBatch]:
        """The ranges that begin at ``firsts``, with what their trials gave."""
        values = ["" if v is None or v != v else v for v in table.column(value).to_pylist()]
        got, verdicts, reasons = {c: [] for c in columns}, [], []
        for at, end in zip(firsts, [*firsts[1:], len(values)], strict=True):
            out, why = trial(values[at:end])
            for c in columns:
                got[c] += [""] * (end - at) if out is None else texts(out, c)
            verdicts += [OK if out is not None else FAIL if end - at == 1 else SPLIT] * (end - at)
            reasons += [why] * (end - at)
        more = [*(pa.array(got[c], pa.string()) for c in columns), pa.array(verdicts, pa.string()), pa.array(reasons, pa.string()), pa.array([task] * len(values), pa.int32())]
        yield from pa.table([*table.columns, *more], [*names, *columns, "_verdict", "_why", "_task"]).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, task = None, TaskContext.get().partitionId()
        with trials(model, seconds) as trial:
            for batch in batches:
                new = pa.Table.from_batches([batch])
                table = new if rest is None else pa.concat_tables([rest, new])
                firsts = np.flatnonzero(table.column("_pos").to_numpy() == table.column("_start").to_numpy()).tolist()
                # The last range may go on in the next batch.
                if len(firsts) > 1:
                    yield from tried(table.slice(0, firsts[-1]), firsts[:-1], trial, task)
                rest = table.slice(firsts[-1]) if firsts else table
            if rest is not None and rest.num_rows:
                yield from tried(rest, [0], trial, task)

    tasks = max(1, min(ranges, TASKS * spark.sparkContext.defaultParallelism))
    # A given number of partitions: ranges are few bytes and much work, and are not to be put together.  Sorted rows
    # go through a task as they come: a group of Spark's own for each range costs more than most trials.
    dealt = work.repartition(tasks, *keys, "_start").sortWithinPartitions(*keys, "_start", "_pos")
    return dealt.mapInArrow(run, _schema(work, *[f"`{c}` string" for c in columns], "_verdict string", "_why string", "_task int"))


def _pieces(fanout: int) -> tuple[Column, Column]:
    """Start and end of the part of a failed range that a row at ``_pos`` is in."""
    n = F.col("_end") - F.col("_start") + 1
    step = F.ceil(n / F.least(n, F.lit(fanout)))
    start = F.col("_start") + F.floor((F.col("_pos") - F.col("_start")) / step) * step
    return start, F.least(start + step - 1, F.col("_end"))


def score_spread(
    chunked: DataFrame, value: str, model: Model, columns: list[str], keys: tuple[str, ...] = ("chunk_no",), fanout: int = 10, seconds: float | None = None, carry: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """:func:`score` with failing rows isolated over the cluster, and the log of the trials.

    Work goes on in rounds.  A round runs all open ranges of all chunks, each in a group of its
    own; those that pass and single rows that fail are done, the others are split into
    ``fanout`` parts for the next round.  After a few rounds, by the logarithm of a chunk's rows, none is open.
    Each round is written, so that a lost executor costs trials of its round only.
    A range that failed while each of its parts passes leaves them UNREPRODUCED, with its details.  ``keys`` are not null.

    The log has a row for each trial: ``keys``, ``start`` and ``end`` among the chunk's rows that are
    not blank, ``round``, ``rows``, ``outcome`` (OK, FAIL or SPLIT), ``details`` and ``task``, its partition in the round.
    """
    wanted = [*keys, "idx", value, *carry]
    rows = chunked.select(*wanted).withColumn("_blank", blank(F.col(value).cast("string")))
    place = Window.partitionBy(*keys)
    live = rows.where(~F.col("_blank")).drop("_blank")
    live = live.withColumn("_pos", F.row_number().over(place.orderBy("idx")) - 1).withColumn("_end", F.count("*").over(place).cast("int") - 1)
    work = materialize(live.withColumns({"_start": F.lit(0), "_above": F.lit(None).cast("int"), "_below": F.lit(None).cast("int"), "_reason": F.lit(None).cast("string")}), "work")
    skipped = rows.where("_blank").select(*wanted, *[F.lit("").alias(c) for c in columns], F.lit(SKIP).alias("status"), F.lit("empty").alias("details"))
    done, log, turn = [skipped], [], 0
    first = F.col("_pos") == F.col("_start")
    ranges = work.where(first).count()
    while ranges:
        tried = materialize(_try_ranges(work, ranges, value, model, columns, keys, seconds), "trials")
        if not turn:
            drop(work)  # all its rows are in the trials
        # A range's first row tells of its trial.
        size = (F.col("_end") - F.col("_start") + 1).cast("bigint")
        told = [F.col("_start").alias("start"), F.col("_end").alias("end"), F.lit(turn).alias("round"), size.alias("rows"), F.col("_verdict").alias("outcome"), F.col("_why").alias("details"), F.col("_task").alias("task")]
        log.append(tried.where(first).select(*keys, *told))
        # A part that passes is reproduced if a part of the same range does not.
        broken = tried.where(F.col("_verdict") != OK).where("_above is not null").select(*keys, "_above", "_below").distinct().withColumn("_with", F.lit(True))
        passed = tried.where(F.col("_verdict") == OK).join(broken, [*keys, "_above", "_below"], "left")
        alone = F.col("_above").isNotNull() & F.col("_with").isNull()
        passed = passed.withColumns({"status": F.when(alone, UNREPRODUCED).otherwise(OK), "details": F.when(alone, F.col("_reason")).otherwise("")})
        failed = tried.where(F.col("_verdict") == FAIL).withColumns({"status": F.lit(FAIL), "details": F.col("_why")})
        done += [f.select(*wanted, *columns, "status", "details") for f in (passed, failed)]
        start, end = _pieces(fanout)
        parts = tried.where(F.col("_verdict") == SPLIT).withColumns({"_a": start.cast("int"), "_b": end.cast("int")})
        work = parts.select(*wanted, "_pos", F.col("_b").alias("_end"), F.col("_a").alias("_start"), F.col("_start").alias("_above"), F.col("_end").alias("_below"), F.col("_why").alias("_reason"))
        ranges = work.where(first).count()
        turn += 1
    if not log:
        log = [work.groupBy(*keys, F.col("_start").alias("start"), F.col("_end").alias("end")).agg(F.lit(0).alias("round"), F.count("*").alias("rows"), F.lit("").alias("outcome"), F.lit("").alias("details"), F.lit(0).alias("task"))]
    return reduce(DataFrame.unionByName, done), reduce(DataFrame.unionByName, log)
