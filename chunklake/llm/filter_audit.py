"""How filters interact, for all orders at once, by the subset-zeta transform (operator 13).

A row's mask has a bit for each filter it fails.  Rows are counted by part and
mask; for k filters that leaves at most 2^k counts a part, however many rows there
are.  The zeta transform turns these counts into the rows that survive each subset
of the filters.  A step of an order is then a difference between two neighbouring
subsets: those applied before it, and those with it; the same holds for the rows
that carry a label.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.llm.common import WORD, materialize, table, texts

NAMES = "ABCDE"


def text_filters(text: Column) -> dict[str, Column]:
    """Whether a text, which is not null, fails: few words, few different words, capitals, signs."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, capitals = F.size(words), F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": n < 50, "B": 100 * F.size(F.array_distinct(words)) < 65 * n, "C": 100 * capitals > 5 * F.length(text), "D": F.regexp_like(text, F.lit(r"[#$%&*|]"))}


def later_copies(rows: DataFrame, digest: str, order: str) -> DataFrame:
    """``rows`` with ``copy``: whether a row with a smaller ``order`` has the same ``digest``.

    Null orders come last; rows that share the least order are no copies.  The least order of
    each digest is found in every task first and meets its rows by digest and order, so that
    a digest with most rows is no task's alone.
    """
    least = rows.groupBy(digest).agg(F.min(order).alias("_least")).withColumnRenamed(digest, "_digest")
    first = (F.col(digest) == F.col("_digest")) & F.col(order).eqNullSafe(F.col("_least"))
    return rows.join(least, first, "left").withColumn("copy", F.col("_digest").isNull()).drop("_digest", "_least")


def masks(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, mask, good, toxic) for each row of ``docs``; bit i of ``mask`` is set if filter i of ABCDE fails.

    A null text is empty; a null part counts as ''.  A document is good or toxic if any of the
    rows of ``labels`` with its doc_id says so.  Repeated ids and null ids are rows of their own: of rows with one text,
    those with the least id are no copies, null ids coming last.  Texts count as identical if their SHA-256 is one.
    """
    failed = [f.cast("int") * (1 << i) for i, f in enumerate(text_filters(F.col("text")).values())]
    facts = texts(docs, F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    facts = facts.select("doc_id", "part", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), sum(failed[1:], failed[0]).alias("mask"))
    facts = later_copies(materialize(facts, "masks"), "digest", "doc_id")
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id"))
    marks = marks.agg(F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    marked = facts.join(marks, F.col("doc_id") == F.col("_id"), "left")
    mask = F.col("mask") + F.col("copy").cast("int") * 16
    return marked.select("part", mask.alias("mask"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")])


def survivors(rows: DataFrame, filters: int, *marks: str) -> DataFrame:
    """(part, n, marks): for each part arrays over all subsets of the filters, by the subset's bits:
    the rows, and the sums of ``marks``, that pass all filters of the subset.

    ``rows`` has part, mask and ``marks``.  Counts by part and mask are summed in each task first.
    """
    every = (1 << filters) - 1
    counts = rows.groupBy("part", "mask").agg(F.count("*").alias("n"), *[F.sum(m).alias(m) for m in marks])
    # At most one entry for each mask.
    held = counts.groupBy("part").agg(*[F.map_from_entries(F.collect_list(F.struct("mask", c))).alias(c) for c in ("n", *marks)])
    for c in ("n", *marks):
        start = f"transform(sequence(0, {every}), m -> coalesce(try_element_at(`{c}`, m), 0L))"
        # After bit i's turn, place s has the counts of all masks that differ from s in bits up to i only, and only by lacking them.
        zeta = f"reduce(sequence(0, {filters - 1}), {start}, (acc, i) -> transform(acc, (x, s) -> x + if((s & (1 << i)) <> 0, acc[s ^ (1 << i)], 0L)))"
        # What passes a subset fails none of it: the masks within its complement.
        held = held.withColumn(c, F.expr(f"reverse({zeta})"))
    return held


def audit(rows: DataFrame, names: str = NAMES, good: str = "good", toxic: str = "toxic", orders: list[str] | None = None) -> DataFrame:
    """One row for each part, order of the filters and step (from 1): kept, removed, redundant,
    unique_fails, good_lost, toxic_lost and shapley.

    ``rows`` has part, mask and two marks; ``names`` has a letter for each bit of the mask.  All orders of ``names`` are
    told unless ``orders`` names some.  No rows, no parts.
    """
    k, every = len(names), (1 << len(names)) - 1
    held = survivors(rows, k, good, toxic)
    weight = ", ".join(str(factorial(i) * factorial(k - 1 - i)) for i in range(k))
    # In how many orders just the filters of p come before filter i, times what i then removes.
    shapley = f"transform(sequence(0, {k - 1}), i -> reduce(sequence(0, {every}), 0L, (t, p) -> t + if((p & (1 << i)) = 0, array({weight})[bit_count(p)] * (n[p] - n[p | (1 << i)]), 0L)))"
    told = F.explode(F.array(*map(F.lit, orders or map("".join, permutations(names)))))
    steps = held.withColumn("_shares", F.expr(shapley)).withColumn("filter_order", told).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
    bit = f"shiftleft(1, instr('{names}', substr(filter_order, step, 1)) - 1)"
    before = f"reduce(sequence(0, {k - 1}), 0, (m, j) -> m | if(instr(substr(filter_order, 1, step - 1), substr('{names}', j + 1, 1)) > 0, 1 << j, 0))"
    steps = steps.withColumn("_bit", F.expr(bit)).withColumn("_before", F.expr(before)).withColumn("_with", F.expr("_before | _bit"))
    lost = lambda c: F.expr(f"`{c}`[_before] - `{c}`[_with]")
    return steps.select(
        "part", "filter_order", "step", F.expr("n[_with]").alias("kept"), lost("n").alias("removed"), (F.expr("n[0] - n[_bit]") - lost("n")).alias("redundant"),
        F.expr(f"n[{every} ^ _bit] - n[{every}]").alias("unique_fails"), lost(good).alias("good_lost"), lost(toxic).alias("toxic_lost"),
        F.expr(f"_shares[instr('{names}', substr(filter_order, step, 1)) - 1]").alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
m AS (SELECT d.part, (len(words) < 50)::INT + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::INT
+ 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * (doc_id > min(doc_id) OVER (PARTITION BY text))::INT AS mask, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic FROM d LEFT JOIN labels l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, mask),
p AS (SELECT DISTINCT part FROM c), f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step::INT AS step, filter_order[step] AS letter, (1 << (ascii(filter_order[step]) - 65))::INT AS bit, coalesce(list_sum([1 << (ascii(filter_order[j]) - 65) FOR j IN range(1, step)]), 0)::INT AS before FROM o, range(1, 6) t(step)),
r AS (SELECT p.part, filter_order, step, letter, coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS toxic_lost
FROM s, p JOIN c USING (part) GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM r
"""

QUERIES = {"op13_filter_audit": op13_filter_audit}
ORACLE_SQL = {"op13_filter_audit": _SQL}
