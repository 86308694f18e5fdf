"""Line dedup by a suffix array over line sequences (operator 2).

Each document is a sequence of lines.  Distributed prefix doubling ranks the
suffixes: the rank of a suffix to depth 2d comes from its rank to depth d and
that of the suffix d lines on.  Suffixes with one rank to depth d are an
interval of the suffix array whose longest common prefix is d lines or more.
Doubling goes on until no two suffixes share a rank; a suffix that is alone, or
whose document ends, leaves at once, so what is doubled shrinks with each round.

The intervals are then walked from the deepest level up: every suffix gets the
longest prefix that it shares with an earlier suffix, to the line.  These are
the maximal repeated runs; a run counts with the words of all its lines, and
the lines of later copies are deleted.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunklake.llm.common import WORD, keyed_rows, materialize, table, whole_rows

MIN_WORDS = 5


def _ranked(keys: DataFrame, on: list[str]) -> DataFrame:
    """``keys`` (distinct) with ``rank``, ascending in the order of ``on``."""
    return materialize(keys.select(*on).orderBy(*on).withColumn("rank", F.monotonically_increasing_id() + 1), "ranks")


def _lines(docs: DataFrame) -> DataFrame:
    """(_row, i, words, line) of ``docs`` with ``_row`` and ``text``."""
    line = F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "t")
    lines = docs.select("_row", line)
    lines = lines.select("_row", "i", F.regexp_count("t", F.lit(WORD)).alias("words"), F.unhex(F.md5("t")).alias("line"))
    return materialize(lines, "lines")


def suffix_ranks(lines: DataFrame) -> list[DataFrame]:
    """For 1, 2, 4 ... lines, the suffixes whose first lines occur elsewhere, with the
    ``rank`` and ``words`` of those lines; until no run of so many lines is repeated.

    Ranks ascend in the order of the suffixes, so a level is the suffix array to
    its depth; equal ranks are its intervals.
    """
    shared = lines.groupBy("line").count().where("count > 1")
    now = lines.join(_ranked(shared, ["line"]), "line").select("_row", "i", "rank", "words")
    out = []
    while True:
        out.append(now := materialize(now, "levels"))
        step = 1 << (len(out) - 1)
        # The suffix ``step`` lines on, if it has not left.
        ahead = now.select("_row", (F.col("i") - step).alias("i"), F.col("rank").alias("then"), F.col("words").alias("more"))
        both = now.join(ahead, ["_row", "i"]).select("_row", "i", F.col("rank").alias("first"), "then", (F.col("words") + F.col("more")).alias("words"))
        names = _ranked(both.groupBy("first", "then").count().where("count > 1"), ["first", "then"])
        if names.isEmpty():
            return out
        now = both.join(names, ["first", "then"]).select("_row", "i", "rank", "words")


def repeated_runs(lines: DataFrame) -> DataFrame:
    """(_row, i, depth, words, at_row, at_i): the longest run from line ``i`` on that
    occurs at an earlier place, and its first place.

    Runs are put together from those of :func:`suffix_ranks`, longest first.  A node
    is the places of one run so far, named by its depth and first place.  Places
    which are not the first of a longer run move to its node; the first stays,
    for all of them, and is in the new node as well.
    """
    levels, deep, names = suffix_ranks(lines), None, ["depth", "at_row", "at_i", "rank"]
    for k in reversed(range(len(levels))):
        nothing = [F.lit(0).alias("depth"), F.lit(0).alias("sum"), F.lit(0).cast("long").alias("at_row"), F.lit(0).alias("at_i")]
        tried = levels[k].select("_row", "i", *nothing, "rank", "words")
        if deep is not None:
            piece = levels[k].select("_row", F.col("i").alias("place"), "rank", "words")
            moved = deep.where("at_row <> _row or at_i <> i").select("_row", "i")
            on = deep.withColumn("place", F.col("i") + F.col("depth")).join(piece, ["_row", "place"], "left").select(tried.columns)
            tried = tried.join(moved, ["_row", "i"], "left_anti").union(on)
        first = tried.where("rank is not null").groupBy(*names).agg(F.min(F.struct("_row", "i")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        # Written, so that the join below deals both sides anew and can split a hot run.
        met = tried.join(materialize(first, "first-copies"), names, "left")
        stay = F.struct("depth", "sum", "at_row", "at_i")
        go = F.struct((F.col("depth") + (1 << k)).alias("depth"), (F.col("sum") + F.col("words")).alias("sum"), F.col("first._row").alias("at_row"), F.col("first.i").alias("at_i"))
        nodes = F.when(F.col("first").isNull(), F.array(stay)).when(F.struct("_row", "i") == F.col("first"), F.array(stay, go)).otherwise(F.array(go))
        deep = materialize(met.select("_row", "i", F.explode(nodes).alias("node")).select("_row", "i", "node.*").where("depth > 0"), "runs")
    return deep.where("at_row <> _row or at_i <> i").select("_row", "i", "depth", F.col("sum").alias("words"), "at_row", "at_i")


def later_copies(runs: DataFrame, min_lines: int = 1, min_words: int = MIN_WORDS) -> DataFrame:
    """(_row, i) of the lines to delete: those in a run of ``min_lines`` lines and
    ``min_words`` words or more that occurs at an earlier place."""
    counts = (F.col("words") >= min_words) & (F.col("depth") >= min_lines)
    # Each line of such a run starts one itself.
    end = F.max(F.when(counts, F.col("i") + F.col("depth"))).over(Window.partitionBy("_row").orderBy("i"))
    return runs.withColumn("end", end).where("end > i").select("_row", "i")


def maximal(runs: DataFrame) -> DataFrame:
    """Of :func:`repeated_runs`, those that do not lie within the one before."""
    before = F.max(F.col("i") + F.col("depth")).over(Window.partitionBy("_row").orderBy("i").rowsBetween(Window.unboundedPreceding, -1))
    return runs.withColumn("_before", before).where("_before is null or i + depth > _before").drop("_before")


def report(docs: DataFrame, min_lines: int = 1, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, line, n_lines, n_words, copies): the first place of each maximal run
    that is repeated, its size, and how many later places repeat it.

    Lines count from 0.  Of a run and a longer one that starts at the same first
    place, each is reported with its own copies.  A null text has one empty line.
    """
    keyed = keyed_rows(docs.select("doc_id", "text"))
    runs = maximal(repeated_runs(_lines(keyed))).where((F.col("words") >= min_words) & (F.col("depth") >= min_lines))
    runs = runs.groupBy("at_row", "at_i", "depth", "words").agg(F.count("*").alias("copies"))
    names = keyed.select(F.col("_row").alias("at_row"), "doc_id")
    return runs.join(names, "at_row").select("doc_id", F.col("at_i").cast("long").alias("line"), F.col("depth").cast("long").alias("n_lines"), F.col("words").cast("long").alias("n_words"), "copies")


def dedup(docs: DataFrame, min_lines: int = 1, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of line runs deleted from ``text``, and ``n_lines``, ``n_removed``, ``n_runs``.

    A line goes if it lies in a run of lines, as long as it may be but of
    ``min_lines`` lines and ``min_words`` words at least, that occurs at an earlier
    place too.  Documents come in the order of doc_id (with repeated or null
    ids: of the table).  Lines end at \\n; a null text has one empty line and
    stays null.  A document that loses all lines stays, with an empty text.
    Columns of any other name are kept; ``n_lines``, ``n_removed`` and ``n_runs`` are replaced.
    """
    keyed = keyed_rows(whole_rows(docs.drop("n_lines", "n_removed", "n_runs"), "doc_id", "text"))
    gone = later_copies(repeated_runs(_lines(keyed)), min_lines, min_words)
    gone = gone.groupBy("_row").agg(F.collect_list("i").alias("gone"))
    joined = keyed.join(gone, "_row", "left")
    lines, none = F.split("text", "\n"), F.array().cast("array<int>")
    joined = joined.withColumn("gone", F.coalesce("gone", none)).withColumn("lines", F.coalesce(lines, F.array(F.lit(""))))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    text = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    changed = F.when(F.size("gone") > 0, text).otherwise(F.col("text"))
    starts = F.array_except(F.col("gone"), F.transform("gone", lambda i: i + 1))
    counts = [F.size(c).cast("long").alias(n) for c, n in (("lines", "n_lines"), ("gone", "n_removed"), (starts, "n_runs"))]
    return joined.select("whole", changed.alias("changed"), *counts).select("whole.*", "changed", "n_lines", "n_removed", "n_runs").withColumn("text", F.col("changed")).drop("changed")


def _summary(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(dedup(table(spark, sf_dir, "documents")))


def op2_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal runs that :func:`op2_line_dedup` deletes copies of."""
    return report(table(spark, sf_dir, "documents"))


_RUNS = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
l AS MATERIALIZED (SELECT doc_id, i, line, len(regexp_extract_all(line, '[^ 	-
]+'))::BIGINT AS words
      FROM (SELECT doc_id, unnest(range(len(a))) AS i, unnest(a) AS line FROM d)),
f AS (SELECT 1::BIGINT AS depth, doc_id, i, md5(line) AS key, words FROM l QUALIFY count(*) OVER (PARTITION BY line) > 1
  UNION ALL
  SELECT depth, doc_id, i, key, words FROM (SELECT f.depth + 1 AS depth, f.doc_id, f.i, md5(f.key || l.line) AS key, f.words + l.words AS words
    FROM f JOIN l ON l.doc_id = f.doc_id AND l.i = f.i + f.depth) QUALIFY count(*) OVER (PARTITION BY key) > 1),
c AS MATERIALIZED (SELECT *, first_value(doc_id) OVER w AS home, first_value(i) OVER w AS place FROM f WINDOW w AS (PARTITION BY depth, key ORDER BY doc_id, i)),
m AS MATERIALIZED (SELECT * FROM c WHERE home <> doc_id OR place <> i QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY depth DESC) = 1)
"""

_SQL = (
    _RUNS
    + """, g AS (SELECT l.*, coalesce(max(CASE WHEN m.words >= 5 THEN m.i + m.depth END) OVER (PARTITION BY l.doc_id ORDER BY l.i) > l.i, false) AS gone
  FROM l LEFT JOIN m ON m.doc_id = l.doc_id AND m.i = l.i),
r AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts FROM g)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed, count(*) FILTER (starts)::BIGINT AS n_runs,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM r GROUP BY doc_id
"""
)

_REPORT_SQL = (
    _RUNS
    + """, x AS (SELECT *, max(i + depth) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM m)
SELECT home AS doc_id, place AS line, depth AS n_lines, words AS n_words, count(*) AS copies
FROM x WHERE (before IS NULL OR i + depth > before) AND words >= 5 GROUP BY home, place, depth, words
"""
)

QUERIES = {"op2_line_dedup": op2_line_dedup, "op2_line_runs": op2_line_runs}
ORACLE_SQL = {"op2_line_dedup": _SQL, "op2_line_runs": _REPORT_SQL}
