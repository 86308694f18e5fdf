"""Mixing sources to target weights by systematic sampling (operator 4).

Each document of a source has the same expected copies, target over size.  In
the order of size, documents' expected copies are summed; one random offset is
added; a document is emitted once for each integer between its sum and the sum
before it.  As neighbours in that order are about as long, the words taken come
within about the longest document of the target.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunklake.llm.common import WORD, materialize, table, texts

MOST = 3.0
WEIGHTS = (1, 2, 3)


def offset(seed: int) -> float:
    return random.Random(seed).random()


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size) to which ``target`` is added.

    Sources in code-point order, null last, have ``weights``, repeating, of all
    sizes.  A target stops at ``most`` times its source; the excess goes to the
    others by weight.  That is a level L with target = min(most * size, L *
    weight); sources fill up in the order of size over weight, so L is found by
    running sums over the sources, of which there are few.
    """
    w = Window.orderBy(F.col("source").isNull(), "source")
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(w) - 1) % len(weights) + 1).cast("double"))
    weighed = weighed.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    filled = weighed.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    filled = filled.withColumn("light", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    filled = filled.withColumn("level", (F.sum("source_size").over(whole) - F.col("capped")) / F.col("light"))
    # The first source that the level does not fill fixes the level for all after it.
    filled = filled.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(whole)["level"])
    return filled.select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, seed: int = 4, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for each row of ``docs``.

    Null texts have size 0.  A source without words has target 0 and no copies.
    Documents are numbered within their source by (size, doc_id, text hash):
    they are sorted over all partitions, and each partition starts where the
    ones before it end, so that no source has to fit into a task.
    """
    sized = texts(docs, "source").select("doc_id", "source", F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"), F.xxhash64("text").alias("h"))
    # Written first: sorting reads its rows twice, and words are counted once.
    sized = materialize(sized, "word-counts")
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["source", "size", "doc_id", "h"]
    placed = sized.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("at", F.monotonically_increasing_id()).drop("h"), "sizes")
    placed = placed.withColumn("part", F.shiftright("at", 33))
    runs = placed.groupBy("source", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"), F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    goals = targets(runs.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    goals = goals.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    runs = runs.select(F.col("source").alias("s"), F.col("part").alias("p"), "first", "before")
    runs = runs.join(goals, runs.s.eqNullSafe(goals.source)).drop("source")
    rows = placed.join(runs, placed.source.eqNullSafe(runs.s) & (placed.part == runs.p))
    rank = F.col("before") + F.col("at") - F.col("first")
    u = F.lit(offset(seed))
    copies = F.floor((rank + 1) * F.col("rate") + u) - F.floor(rank * F.col("rate") + u)
    return rows.select("doc_id", "source", "size", "source_size", "target", F.least(copies, F.lit(int(most))).cast("long").alias("copies"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight, source_size * 3.0::DOUBLE AS cap FROM s),
f AS (SELECT *, coalesce(sum(cap) OVER o, 0.0) AS capped, (SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER o, 0.0) AS light
      FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, ((SELECT sum(source_size) FROM w) - capped) / light AS level FROM f),
g AS (SELECT source, source_size, least(cap, weight * (SELECT first(level ORDER BY cap / weight, level) FROM l WHERE level * weight <= cap)) AS target FROM l),
r AS (SELECT d.*, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
      row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1 AS n FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, ((floor((n + 1) * rate + {offset(4)!r}::DOUBLE) - floor(n * rate + {offset(4)!r}::DOUBLE)) * size)::BIGINT AS taken FROM r
"""

QUERIES = {"op4_mixing": op4_mixing}
ORACLE_SQL = {"op4_mixing": _SQL}
