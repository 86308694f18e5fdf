"""Registered queries of the library's operators on the driver's tables, and their SQL.

The tables hold no compounds, so each operator runs on a stand-in.
"""

from __future__ import annotations

import bz2
import gzip
import io
import uuid
import zipfile

from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.functions.text import CHUNK_FILE, all_empty, message, number_in, relative, shorten
from chunklake.operators import chunking, fragments, merge, models, reconcile, runs
from chunklake.operators.columns import extract
from chunklake.operators.runners import Command
from chunklake.sources import chunk_sink, text_files
from chunklake.sources.archive import Layout, archives_of, read_archive
from chunklake.sources.catalog import Catalogue
from chunklake.sources.shared import materialize, shared_dir
from chunklake.streaming import incremental
from chunklake.streaming.incremental import checkpoint_rows, ingest, pending, until_complete

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

# Aliases of names, in lower case.
ALIASES = {"fr": "FRANCE", "france": "FRANCE", "us": "UNITED STATES", "nation_1": "NATION ONE"}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _chunked(spark: SparkSession, d: str, size: int = 10) -> DataFrame:
    return chunking.chunk(_t(spark, d, "orders").select("o_orderkey"), "o_orderkey", size=size)


_C = "c AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) AS ordinal FROM orders), k AS (SELECT *, (ordinal // 10)::INT AS chunk_no, (ordinal % 10)::INT AS idx, format('{:03d}', ordinal // 10) AS chunk_label FROM c)"


@_query("SELECT trim(p_name) AS smiles, p_partkey::VARCHAR AS collection_id FROM part WHERE trim(p_name) <> ''")
def Q01_extract_rows(spark, d):
    # Blanks that SQL's trim leaves are stripped as well.
    padded = _t(spark, d, "part").withColumn("p_name", F.concat(F.lit(" \t\u00a0"), "p_name", F.lit("\u2003 ")))
    return extract(padded, "p_name", "p_partkey")


@_query("SELECT trim(p_name) AS smiles, '' AS collection_id FROM part WHERE trim(p_name) <> ''")
def Q02_resolve_columns(spark, d):
    return extract(_t(spark, d, "part"), "P_NAME", "missing_id")


@_query(f"WITH {_C} SELECT o_orderkey, chunk_no, chunk_label, idx FROM k")
def Q03_chunk_assign(spark, d):
    return _chunked(spark, d).select("o_orderkey", "chunk_no", "chunk_label", "idx")


@_query(f'WITH {_C} SELECT chunk_no, chunk_label, count(*) AS "rows" FROM k GROUP BY ALL')
def Q04_chunk_manifest(spark, d):
    return chunking.manifest(_chunked(spark, d))


@_query("""SELECT library, count(*) AS total, ((count(*) + 9999) // 10000)::BIGINT AS chunks FROM (SELECT 'part' AS library FROM part
UNION ALL SELECT 'customer' FROM customer UNION ALL SELECT 'supplier' FROM supplier UNION ALL SELECT 'orders' FROM orders) GROUP BY library""")
def Q05_library_summary(spark, d):
    return chunking.summary(merge.by_position([_t(spark, d, t).select(F.lit(t).alias("library")) for t in ("part", "customer", "supplier", "orders")]))


@_query(f"WITH {_C}, m AS (SELECT DISTINCT chunk_no, chunk_label FROM k) SELECT chunk_no, chunk_label, row_number() OVER (ORDER BY chunk_label) - 1 AS place FROM m")
def Q06_lexical_merge_order(spark, d):
    m = chunking.manifest(_chunked(spark, d)).drop("rows")
    return chunking.number(m, "chunk_label", name="place").select("chunk_no", "chunk_label", F.col("place").cast("bigint").alias("place"))


@_query(f"""WITH {_C}, m AS (SELECT DISTINCT chunk_no, chunk_label FROM k), r AS (SELECT *, row_number() OVER (ORDER BY chunk_no) - 1 AS place,
row_number() OVER (ORDER BY chunk_label) - 1 AS lexical FROM m) SELECT chunk_no, place, lexical - place AS displaced FROM r""")
def Q07_numeric_merge_order(spark, d):
    m = chunking.manifest(_chunked(spark, d)).drop("rows")
    both = chunking.number(chunking.number(m, "chunk_no", name="place"), "chunk_label", name="lexical")
    return both.select("chunk_no", F.col("place").cast("bigint").alias("place"), (F.col("lexical") - F.col("place")).cast("bigint").alias("displaced"))


@_query(f"WITH {_C}, m AS (SELECT DISTINCT chunk_no::BIGINT AS position FROM k) SELECT position, (position // 1000)::BIGINT AS batch, (position % 1000)::INT AS task FROM m")
def Q08_batch_lists(spark, d):
    m = chunking.manifest(_chunked(spark, d)).select(F.col("chunk_no").cast("bigint").alias("position"))
    return m.select("position", *chunking.batches())


@_query(f"""WITH {_C}, f AS (SELECT DISTINCT 'orders_chunk_' || chunk_label || '.csv' AS name FROM k)
SELECT name, regexp_extract(name, '(?:^|_)chunk_(\\d+)\\.csv$', 1)::INT AS chunk_no FROM f WHERE name LIKE '%\\_chunk\\_%' ESCAPE '\\' AND name LIKE '%.csv'""")
def Q09_chunk_number_extract(spark, d):
    m = chunking.manifest(_chunked(spark, d)).select(F.concat(F.lit("orders_chunk_"), "chunk_label", F.lit(".csv")).alias("name"))
    return m.where(F.col("name").endswith(".csv") & F.col("name").contains("_chunk_")).select("name", number_in(F.col("name")).alias("chunk_no"))


def _folder(spark) -> str:
    """A new folder for the files that a query writes and reads back."""
    return f"{shared_dir(spark)}/chunklake/{spark.sparkContext.applicationId}/files-{uuid.uuid4().hex}"


def _write(uri: str, data: bytes) -> str:
    store, path = FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0])
    with store.open_output_stream(path, compression=None) as out:
        out.write(data)
    return uri


def _nations(spark, d):
    """The 25 nations as (region, name, key)."""
    return [(r.n_regionkey, r.n_name, r.n_nationkey) for r in _t(spark, d, "nation").orderBy("n_nationkey").collect()]


def _write_zip(path: str, rows: list[tuple[str, str]]) -> None:
    """An archive whose largest member has the rows, beside one with half of them and one of another kind."""
    held, lines = io.BytesIO(), [f"{i},\" {u.replace('"', '""')}\"\r\n" for u, i in rows]
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("__MACOSX/big.csv", "x" * 500_000)
        for name, some in (("half.smiles", lines[: len(lines) // 2]), ("all.smiles", lines)):
            z.writestr(name, "sep=,\r\n Catalog ID,smiles\r\n" + "".join(some))
    _write(path, held.getvalue())


@_query("SELECT trim(url) AS smiles, page_id::VARCHAR AS collection_id, 0 AS member FROM pages WHERE trim(url) <> ''")
def Q10_member_select(spark, d):
    """Archives of some hundred pages each, written by tasks; the largest member of each counts."""
    folder = _folder(spark)
    pages = _t(spark, d, "pages").where("trim(url) <> ''").select(F.expr("page_id div 500").alias("part"), F.trim("url").alias("url"), "page_id")

    def write(frame):
        path = f"{folder}/{frame['part'].iloc[0]}.zip"
        _write_zip(path, [(u, str(i)) for u, i in zip(frame["url"], frame["page_id"], strict=True)])
        return frame[["part"]].head(1).assign(path=path)[["path"]]

    # Written before it is read: a repeated task writes the same archive.
    paths = materialize(pages.groupBy("part").applyInPandas(write, "path string"), "archives")
    found = archives_of(paths, Layout("largest", ",", "SMILES", "CATALOG ID"))
    return found.select("smiles", "collection_id", "member")


@_query("""SELECT n_nationkey, n_name, CASE lower(n_name) WHEN 'fr' THEN 'FRANCE' WHEN 'france' THEN 'FRANCE' WHEN 'us' THEN 'UNITED STATES'
WHEN 'nation_1' THEN 'NATION ONE' ELSE n_name END AS library FROM nation""")
def Q11_alias_resolve(spark, d):
    known = Catalogue({}, {}, aliases=ALIASES)
    return _t(spark, d, "nation").select("n_nationkey", "n_name", known.library_of(F.col("n_name")).alias("library"))


@_query("SELECT p_partkey, md5(p_name) AS key, p_name AS input FROM part")
def Q12_result_key(spark, d):
    return _t(spark, d, "part").select("p_partkey", F.md5("p_name").alias("key"), F.col("p_name").alias("input"))


def _sets(spark, d):
    e = _t(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("k"))
    return e, _t(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"))


_E, _A = "SELECT o_custkey AS k FROM orders WHERE o_totalprice > 300000", "SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0"


@_query(f"{_E} EXCEPT {_A}")
def Q13_missing_chunks(spark, d):
    e, a = _sets(spark, d)
    return reconcile.missing(e, a, "k")


@_query(f"{_A} EXCEPT {_E}")
def Q14_extra_chunks(spark, d):
    e, a = _sets(spark, d)
    return reconcile.missing(a, e, "k")


@_query(f"{_E} INTERSECT {_A}")
def Q15_present_chunks(spark, d):
    e, a = _sets(spark, d)
    return reconcile.present(e, a, "k")


@_query("""WITH e AS (SELECT DISTINCT c_nationkey AS n, c_custkey AS k FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 300000),
a AS (SELECT c_nationkey AS n, c_custkey AS k FROM customer WHERE c_acctbal > 0),
j AS (SELECT coalesce(e.n, a.n) AS nation, e.k AS e, a.k AS a FROM e FULL JOIN a ON e.n = a.n AND e.k = a.k),
g AS (SELECT nation, count(e) AS expected, count(*) FILTER (e IS NOT NULL AND a IS NOT NULL) AS present, count(*) FILTER (a IS NULL) AS missing, count(*) FILTER (e IS NULL) AS extra FROM j GROUP BY nation)
SELECT *, CASE WHEN expected = 0 THEN 'NO INPUT' WHEN present = 0 THEN 'NOT RUN' WHEN missing > 0 THEN 'INCOMPLETE' ELSE 'COMPLETE' END AS status FROM g""")
def Q16_completeness_status(spark, d):
    c = _t(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("k"), "c_acctbal")
    e = c.join(_sets(spark, d)[0].distinct(), "k", "left_semi")
    return reconcile.completeness(e, c.where("c_acctbal > 0"), "k", "nation")


@_query("""WITH i AS (SELECT doc_id // 4 AS chunk, count(*) AS rows_in FROM documents GROUP BY 1), o AS (SELECT doc_id // 4 AS chunk, count(*) AS rows_out FROM labels GROUP BY 1)
SELECT chunk, rows_in, coalesce(rows_out, 0) AS rows_out, CASE WHEN rows_out IS NULL THEN 'MISSING' WHEN rows_out <> rows_in THEN 'MISMATCH' ELSE 'OK' END AS status FROM i LEFT JOIN o USING (chunk)""")
def Q17_row_mismatch(spark, d):
    chunk = F.expr("doc_id div 4").alias("chunk")
    return reconcile.compare_counts(_t(spark, d, "documents").select(chunk), _t(spark, d, "labels").select(chunk), "chunk")


def _labelled(spark, d):
    return _t(spark, d, "documents").select("doc_id", "source").join(_t(spark, d, "labels"), "doc_id", "left")


@_query("""SELECT source, count(*) AS total, count(*) FILTER (quality IS NULL AND toxic IS NULL) AS empty,
count(*) FILTER (quality IS NULL AND toxic IS NULL) * 100.0::DOUBLE / count(*) AS empty_pct FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""")
def Q18_empty_results(spark, d):
    empty = all_empty([F.col("quality").cast("string"), F.col("toxic").cast("string")])
    g = _labelled(spark, d).groupBy("source").agg(F.count("*").alias("total"), F.count_if(empty).alias("empty"))
    return g.withColumn("empty_pct", F.col("empty") * 100.0 / F.col("total"))


_R = 'count(*) AS "input", count(quality) AS valid, count(*) - count(quality) AS empty, count(quality) / count(*) * 100 AS retention_pct FROM documents LEFT JOIN labels USING (doc_id)'


@_query(f"SELECT source, {_R} GROUP BY source")
def Q19_retention(spark, d):
    return reconcile.retention(_labelled(spark, d), "source", F.col("quality").isNotNull())


@_query(f"SELECT source, {_R} GROUP BY ROLLUP (source)")
def Q20_retention_total(spark, d):
    return reconcile.retention(_labelled(spark, d), "source", F.col("quality").isNotNull(), total=True)


@_query("""SELECT source, array_to_string(list_sort(list(doc_id))[1:20], ',') AS items, greatest(count(*) - 20, 0)::BIGINT AS more
FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY source""")
def Q21_list_preview(spark, d):
    rows = pending(_t(spark, d, "documents").select("doc_id", "source"), _t(spark, d, "labels"), "doc_id")
    return reconcile.preview(rows, "source", "doc_id").withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


@_query("""SELECT count(*) AS ran, count(*) FILTER (quality IS NOT NULL) AS done, bool_or(quality IS NULL) AS incomplete FROM documents LEFT JOIN labels USING (doc_id)""")
def Q22_run_verdict(spark, d):
    return reconcile.verdict(_labelled(spark, d), F.col("quality").isNotNull())


def _ranges(spark, d):
    m = chunking.manifest(_chunked(spark, d, 700))
    return chunking.split_ranges(m.select("chunk_no", F.lit(0).cast("bigint").alias("start"), (F.col("rows") - 1).alias("end")))


_S = """n AS (SELECT ((row_number() OVER (ORDER BY o_orderkey) - 1) // 700)::INT AS chunk_no FROM orders), m AS (SELECT chunk_no, count(*) AS n FROM n GROUP BY 1),
p AS (SELECT *, (n + least(n, 10) - 1) // least(n, 10) AS piece FROM m), s AS (SELECT chunk_no, n, i * piece AS start, least((i + 1) * piece, n) - 1 AS "end"
FROM (SELECT *, unnest(range((n - 1) // piece + 1)) AS i FROM p))"""


@_query(f'WITH {_S} SELECT chunk_no, start::BIGINT AS start, "end"::BIGINT AS "end" FROM s')
def Q23_split_ranges(spark, d):
    return _ranges(spark, d).select("chunk_no", "start", "end")


@_query(f'WITH {_S} SELECT chunk_no, sum("end" - start + 1)::BIGINT AS covered, min(start)::BIGINT AS first, max("end")::BIGINT AS last FROM s GROUP BY 1')
def Q24_range_to_index(spark, d):
    """Ranges cover their chunk: told from their ends."""
    return _ranges(spark, d).groupBy("chunk_no").agg(F.sum(F.expr("`end` - start + 1")).alias("covered"), F.min("start").alias("first"), F.max("end").alias("last"))


@_query(f'WITH {_S} SELECT chunk_no, unnest(range(start, "end" + 1))::BIGINT AS idx FROM s WHERE start % 3 = 1')
def Q25_coverage_gap(spark, d):
    r = _ranges(spark, d)
    sizes = r.groupBy("chunk_no").agg((F.max("end") + 1).alias("size"))
    return merge.gaps(r.where("start % 3 <> 1"), sizes, "chunk_no").select("chunk_no", F.explode(F.sequence("start", "end")).alias("idx"))


@_query("SELECT doc_id, source, coalesce(quality::VARCHAR, '') AS quality, coalesce(toxic::VARCHAR, '') AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def Q26_pad_failures(spark, d):
    return merge.pad(_t(spark, d, "documents").select("doc_id", "source"), _t(spark, d, "labels"), "doc_id")


@_query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def Q27_resume_pending(spark, d):
    return pending(_t(spark, d, "documents").select("doc_id"), _t(spark, d, "labels"), "doc_id")


@_query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::VARCHAR AS success_key FROM documents JOIN labels USING (doc_id)")
def Q28_success_index(spark, d):
    done = _t(spark, d, "documents").select("doc_id").join(_t(spark, d, "labels"), "doc_id", "left_semi")
    return chunking.number(done, "doc_id", name="k").select("doc_id", F.col("k").cast("string").alias("success_key"))


@_query("""SELECT event_id, 'EXIT ' || (user_id % 7)::VARCHAR || ': ' || substr(replace(props, chr(10), ' | '), 1, 300) AS details FROM events WHERE event_type = 'error'""")
def Q29_error_details(spark, d):
    return _t(spark, d, "events").where("event_type = 'error'").select("event_id", message(F.expr("user_id % 7"), F.col("props")).alias("details"))


@_query("SELECT label, count(*) AS n, max(len(embedding))::INT AS dim, count(*) FILTER (len(embedding) <> 64) AS wrong FROM embeddings GROUP BY label")
def Q30_vector_check(spark, d):
    return reconcile.vector_counts(_t(spark, d, "embeddings"), "label", "embedding", 64)


@_query("SELECT p_name, p_brand, p_type FROM part UNION ALL SELECT p_name, '' AS p_brand, p_type FROM part")
def Q31_merge_by_name(spark, d):
    p = _t(spark, d, "part")
    return merge.by_name([p.select("p_name", "p_brand", "p_type"), p.select("p_type", "p_name")])


@_query("SELECT p_name AS a, p_brand AS b FROM part UNION ALL SELECT p_brand, p_name FROM part")
def Q32_merge_by_position(spark, d):
    p = _t(spark, d, "part")
    return merge.by_position([p.select(F.col("p_name").alias("a"), F.col("p_brand").alias("b")), p.select("p_brand", "p_name")])


# A row fails if it holds this, and is skipped if blank.
_POISON = "&&&"


def length_model(values: list[str]):
    """A model in place of a real one: lengths and hashes; a row with the poison fails its batch."""
    import hashlib

    import pandas as pd

    if any(_POISON in v for v in values):
        raise ValueError("bad row")
    return pd.DataFrame({"n": [str(len(v)) for v in values], "h": [hashlib.md5(v.encode()).hexdigest()[:8] for v in values]})


def _scored(spark, d):
    docs = chunking.chunk(_t(spark, d, "documents").select("doc_id", "text"), "doc_id", size=100)
    return models.score(docs, "text", length_model, ["n", "h"], carry=("doc_id",)).select("doc_id", "chunk_no", "idx", "n", "h", "status")


_V = "SELECT doc_id, text, CASE WHEN trim(text) = '' THEN 'SKIP' WHEN contains(text, '&&&') THEN 'FAIL' ELSE 'OK' END AS status FROM documents"


@_query(f"SELECT status, count(*) AS n FROM ({_V}) GROUP BY status")
def Q33_failure_summary(spark, d):
    return _scored(spark, d).groupBy("status").agg(F.count("*").alias("n"))


@_query(f"SELECT doc_id FROM ({_V}) WHERE status = 'FAIL'")
def Q34_isolate_poison(spark, d):
    return _scored(spark, d).where(F.col("status") == models.FAIL).select("doc_id")


@_query(f"SELECT doc_id, status, CASE status WHEN 'OK' THEN length(text)::VARCHAR ELSE '' END AS n, CASE status WHEN 'OK' THEN substr(md5(text), 1, 8) ELSE '' END AS h FROM ({_V})")
def Q35_model_score(spark, d):
    return _scored(spark, d).select("doc_id", "status", "n", "h")


@_query(f'WITH {_C} SELECT chunk_no // 100 AS shard, count(*) AS "rows" FROM k GROUP BY 1')
def Q36_shard_count(spark, d):
    return _chunked(spark, d).groupBy(F.expr("chunk_no div 100").cast("int").alias("shard")).agg(F.count("*").alias("rows"))


_F = "n AS (SELECT p_partkey, p_name, p_brand, ((row_number() OVER (ORDER BY p_partkey) - 1) // 50)::INT AS chunk_no, ((row_number() OVER (ORDER BY p_partkey) - 1) % 50)::INT AS idx FROM part)"


def _parts(spark, d):
    """Parts in chunks of 50; the names have quotes, commas and backslashes."""
    odd = F.concat(F.lit(' "'), "p_name", F.lit(', a\\b" '))
    return chunking.chunk(_t(spark, d, "part").select("p_partkey", "p_brand", odd.alias("smiles")), "p_partkey", size=50)


@_query(f"WITH {_F} SELECT chunk_no, count(*) AS lines FROM n GROUP BY 1 UNION ALL SELECT max(chunk_no) + 1, 0 FROM n")
def Q37_chunk_lines(spark, d):
    """Lines after the header in each file; an empty chunk has a file as well."""
    path, parts = _folder(spark), _parts(spark, d)
    labels = parts.select("chunk_no").union(parts.agg((F.max("chunk_no") + 1).alias("chunk_no")))
    chunk_sink.export_chunks(parts, path, "part", "smiles", labels=labels)
    return text_files.physical_lines(spark, path).select(number_in(F.substring_index("path", "/", -1)).alias("chunk_no"), F.col("rows").alias("lines"))


@_query("SELECT n_name AS smiles, n_nationkey::VARCHAR AS collection_id, n_regionkey AS member FROM nation")
def Q38_archive_shards(spark, d):
    """An archive of a gzip member for each region, in another order than their names."""
    held, rows = io.BytesIO(), _nations(spark, d)
    with zipfile.ZipFile(held, "w") as z:
        for k in sorted({r[0] for r in rows}, reverse=True):
            z.writestr(f"{k}.txt.gz", gzip.compress(("id\tx\tsmiles\n" + "".join(f"{i}\t\t{n}\n" for r, n, i in rows if r == k)).encode()))
    path = _write(f"{_folder(spark)}/b.zip", held.getvalue())
    return read_archive(spark, path, Layout("each", "\t", "smiles", "id", (".txt.gz",))).select("smiles", "collection_id", "member")


@_query("SELECT n_name AS smiles, n_nationkey::VARCHAR AS collection_id, (row_number() OVER (ORDER BY n_nationkey) - 1) AS place FROM nation")
def Q39_archive_bz2(spark, d):
    data = bz2.compress(("smiles\tid\n" + "".join(f"{n}\t{i}\n" for _, n, i in _nations(spark, d))).encode())
    found = read_archive(spark, _write(f"{_folder(spark)}/c.bz2", data), Layout("whole", "\t", "SMILES", "ID"))
    return chunking.number(found, "row", name="place").select("smiles", "collection_id", F.col("place").cast("bigint").alias("place"))


@_query("SELECT n_name AS smiles, n_nationkey::VARCHAR AS id, '' AS note FROM nation")
def Q40_sep_line(spark, d):
    """A file whose first line names its delimiter; rows may be short."""
    data = "sep=;\r\nsmiles;id;note\r\n" + "".join(f"{n};{i}{';' * (i % 2)}\r\n" for _, n, i in _nations(spark, d))
    return text_files.read_csv(spark, _write(f"{_folder(spark)}/d.csv", data.encode()))


def _ranges_as_files(rows, path, label, start, end, *columns):
    """``rows`` as files result_START_END.csv, in a folder for each chunk."""
    chunk_sink.export_files(rows, path, label, F.format_string("chunk_%03d/result_%d_%d.csv", "chunk_no", start, end), "idx", *columns)


def _read_ranges(spark, path):
    return text_files.read_ranges(spark, path).withColumn("chunk_no", F.regexp_extract("file", r"chunk_(\d+)/", 1).cast("int"))


@_query(f"WITH {_F} SELECT chunk_no, (idx // 10 * 10)::BIGINT AS start, p_brand, idx::BIGINT AS idx FROM n")
def Q41_range_fragments(spark, d):
    """Sub-results of ten rows, named by their range; a checkpoint is none of them."""
    path, rows = _folder(spark), _parts(spark, d)
    start = F.expr("idx div 10 * 10")
    _ranges_as_files(rows, path, "fragments", start, start + 9, "p_brand")
    chunk_sink.export_files(rows, path, "other", F.format_string("chunk_%03d/result_0_9.checkpoint.csv", "chunk_no"), "idx", "p_brand")
    return _read_ranges(spark, path).select("chunk_no", "start", "p_brand", "idx")


@_query("""SELECT (user_id % 50)::INT AS __idx__, max_by(event_type, event_id) AS event_type FROM events WHERE event_id % 7 <> 3 GROUP BY 1""")
def Q42_checkpoint_latest(spark, d):
    """Checkpoint rows as text, some without a usable index; the later row counts."""
    bad = F.when(F.col("event_id") % 7 == 3, F.when(F.col("event_id") % 2 == 0, "").otherwise("n/a"))
    rows = _t(spark, d, "events").select(F.coalesce(bad, F.expr("cast(user_id % 50 AS string)")).alias("__idx__"), "event_type", "event_id")
    return checkpoint_rows(rows, "event_id").select("__idx__", "event_type")


@_query("SELECT 'region_' || r_regionkey::VARCHAR AS library, CASE r_regionkey % 3 WHEN 0 THEN 'RUN' WHEN 1 THEN 'NO_RESULTS' ELSE 'NO_OUTPUT_DIR' END AS status FROM region")
def Q43_discovered_status(spark, d):
    """Libraries are folders; some hold results of a model, some nothing of it, some no folder."""
    root, regions = _folder(spark), [r.r_regionkey for r in _t(spark, d, "region").collect()]
    for k in regions:
        if k % 3 < 2:
            _write(f"{root}/region_{k}/{'m' if k % 3 == 0 else 'other'}/m_results_000.csv", b"a\n1\n")
    every = _t(spark, d, "region").select(F.concat(F.lit("region_"), "r_regionkey").alias("library"))
    return reconcile.run_status(every, text_files.libraries(spark, root), text_files.libraries(spark, root, "m"), "library")


@_query(f"WITH {_F} SELECT DISTINCT chunk_no FROM n UNION ALL SELECT chunk_no FROM n WHERE false")
def Q44_chunk_listing(spark, d):
    """Numbers of the files in a folder, and of a folder that is not there."""
    path = _folder(spark)
    chunk_sink.export_chunks(_parts(spark, d), path, "part", "smiles")
    return text_files.chunk_numbers(spark, path).union(text_files.chunk_numbers(spark, f"{path}-none"))


@_query("""WITH i AS (SELECT source, doc_id // 4 AS c, count(*) AS a FROM documents GROUP BY ALL), o AS (SELECT d.source, l.doc_id // 4 AS c, count(*) AS b, count(*) FILTER (l.quality = 0) AS e FROM labels l JOIN documents d USING (doc_id) GROUP BY ALL)
SELECT source, count(*) AS chunks, count(*) FILTER (b IS NULL) AS missing, count(*) FILTER (b <> a) AS mismatched, sum(a)::BIGINT AS rows_in, coalesce(sum(b), 0)::BIGINT AS rows_out, coalesce(sum(e), 0)::BIGINT AS empty
FROM i LEFT JOIN o USING (source, c) GROUP BY ROLLUP (source)""")
def Q45_library_report(spark, d):
    docs = _t(spark, d, "documents").select("source", "doc_id", F.expr("doc_id div 4").alias("chunk"))
    outputs = docs.join(_t(spark, d, "labels"), "doc_id")
    return reconcile.report(docs, outputs, "source", "chunk", F.col("quality") != 0)


@_query("""SELECT v.vec_id, p.p_partkey FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS n FROM embeddings) v
JOIN (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS n FROM part) p USING (n)""")
def Q46_positional_pair(spark, d):
    return merge.pair(_t(spark, d, "embeddings").select("vec_id"), _t(spark, d, "part").select("p_partkey"), "vec_id", "p_partkey").select("vec_id", "p_partkey")


@_query("SELECT c_custkey, c_custkey * 2 AS v, 0::BIGINT AS remain FROM customer")
def Q47_retry_until_complete(spark, d):
    """Each round finishes half of what is pending, until nothing is."""
    rows, target = _t(spark, d, "customer").select("c_custkey"), _folder(spark)

    def run(p):
        n = p.count()
        return p.where((F.xxhash64("c_custkey", F.lit(n)) % 2 == 0) | F.lit(n < 10)).withColumn("v", F.col("c_custkey") * 2)

    rows.limit(0).withColumn("v", F.col("c_custkey") * 2).write.parquet(target)
    left, _ = until_complete(rows, "c_custkey", run, target, most=60)
    return spark.read.parquet(target).withColumn("remain", F.lit(left.count()).cast("bigint"))


def slow_model(values: list[str]):
    """Takes too long over batches with a large region."""
    import time

    import pandas as pd

    if "SLOW" in values:
        time.sleep(30)
    return pd.DataFrame({"n": [str(len(v)) for v in values]})


@_query("""SELECT n_nationkey, CASE WHEN n_nationkey = 7 THEN '' ELSE length(n_name)::VARCHAR END AS n, CASE WHEN n_nationkey = 7 THEN 'FAIL' ELSE 'OK' END AS status,
CASE WHEN n_nationkey = 7 THEN 'TIMEOUT after 1 s' ELSE '' END AS details FROM nation""")
def Q48_time_limit(spark, d):
    """A row that takes too long is isolated, and its batch goes on without it."""
    rows = _t(spark, d, "nation").select("n_nationkey", F.when(F.col("n_nationkey") == 7, "SLOW").otherwise(F.col("n_name")).alias("name"))
    chunked = chunking.chunk(rows, "n_nationkey", size=10)
    return models.score(chunked, "name", slow_model, ["n"], seconds=1, carry=("n_nationkey",)).select("n_nationkey", "n", "status", "details")


@_query("SELECT o_orderkey, o_orderstatus || '!' AS s FROM orders")
def Q49_incremental_ingest(spark, d):
    """Two loads of new files through one checkpoint; each row comes once."""
    root, rows = _folder(spark), _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    for part in range(2):
        rows.where(F.col("o_orderkey") % 2 == part).write.mode("append").parquet(f"{root}/in")
        ingest(spark, f"{root}/in", "o_orderkey long, o_orderstatus string", f"{root}/out", f"{root}/checkpoint", lambda s: s.select("o_orderkey", F.concat("o_orderstatus", F.lit("!")).alias("s"))).awaitTermination()
    return spark.read.schema("o_orderkey long, s string").parquet(f"{root}/out").drop("batch")


@_query("SELECT doc_id, substr(text, 1, 50) AS shown, source || '/x.csv' AS relative FROM documents")
def Q50_shown_text(spark, d):
    return _t(spark, d, "documents").select("doc_id", shorten(F.col("text"), 50).alias("shown"), relative(F.concat(F.lit("/data/out/"), "source", F.lit("/x.csv")), "/data/out").alias("relative"))


@_query("SELECT n_name AS smiles FROM nation")
def Q51_first_column(spark, d):
    """The first column of the first file by name, whatever its header."""
    path = _folder(spark)
    _write(f"{path}/x_chunk_001.csv", b"s\nno\n")
    _write(f"{path}/x_chunk_000.csv", ("odd name,b\n" + "".join(f"{n},1\n" for _, n, _ in _nations(spark, d))).encode())
    return text_files.first_column(text_files.read_csv(spark, text_files.first_file(spark, path)))


@_query(f"WITH {_F} SELECT chunk_no, ' \"' || p_name || ', a\\b\" ' AS smiles, p_brand FROM n")
def Q52_numbered_files(spark, d):
    """Chunks written as numbered files, found by their names and read back."""
    path = _folder(spark)
    chunk_sink.export_chunks(_parts(spark, d), path, "part", "smiles", "p_brand")
    return text_files.read_chunks(spark, path, CHUNK_FILE).select("chunk_no", "smiles", "p_brand")


# Models that fail, over the cluster and as commands.


def _many(spark, d):
    return chunking.chunk(_t(spark, d, "documents").select("doc_id", "text"), "doc_id", size=500)


@_query(f"SELECT doc_id, status, CASE status WHEN 'OK' THEN length(text)::VARCHAR ELSE '' END AS n, CASE status WHEN 'FAIL' THEN 'bad row' WHEN 'SKIP' THEN 'empty' ELSE '' END AS details FROM ({_V})")
def Q53_spread_isolation(spark, d):
    """Several failing rows in a chunk, isolated by rounds of ranges over all tasks."""
    scored, _ = models.score_spread(_many(spark, d), "text", length_model, ["n", "h"], carry=("doc_id",))
    return scored.select("doc_id", "status", "n", "details")


@_query("""WITH RECURSIVE r AS (SELECT doc_id, text, ((row_number() OVER (ORDER BY doc_id) - 1) // 500)::INT AS chunk_no FROM documents),
l AS (SELECT chunk_no, (row_number() OVER (PARTITION BY chunk_no ORDER BY doc_id) - 1)::BIGINT AS pos, contains(text, '&&&') AS bad FROM r WHERE trim(text) <> ''),
t AS (SELECT 0 AS round, chunk_no, 0::BIGINT AS a, max(pos) AS b, bool_or(bad) AS bad FROM l GROUP BY chunk_no
UNION ALL SELECT round, s.chunk_no, s.a, s.b, (SELECT bool_or(bad) FROM l WHERE l.chunk_no = s.chunk_no AND pos BETWEEN s.a AND s.b) AS bad
FROM (SELECT round + 1 AS round, chunk_no, a + i * p AS a, least(a + (i + 1) * p - 1, b) AS b FROM (SELECT *, unnest(range((b - a) // p + 1)) AS i FROM (SELECT *, (b - a + least(b - a + 1, 10)) // least(b - a + 1, 10) AS p FROM t WHERE bad AND b > a))) s)
SELECT round, CASE WHEN NOT bad THEN 'OK' WHEN a = b THEN 'FAIL' ELSE 'SPLIT' END AS outcome, count(*) AS trials, sum(b - a + 1)::BIGINT AS "rows" FROM t GROUP BY 1, 2""")
def Q54_isolation_trials(spark, d):
    """The log of the trials that find the failing rows, by round and outcome."""
    _, log = models.score_spread(_many(spark, d), "text", length_model, ["n", "h"])
    return log.groupBy("round", "outcome").agg(F.count("*").alias("trials"), F.sum("rows").alias("rows"))


# A command in place of a real model: CSV in, CSV out; each run has a process, which a row with the poison ends with an exit code.
# It needs the reader and the writer of csv only, whose other imports take as long as its start.
_COMMAND = """
import os, sys
from _csv import field_size_limit, reader, writer
field_size_limit(10**8)
for line in sys.stdin:
    source, target = line.rstrip("\\n").split("\\t")
    run = os.fork()
    if not run:
        with open(source, newline="", encoding="utf-8") as f, open(target, "w", newline="", encoding="utf-8") as g:
            rows, out = reader(f), writer(g)
            place = next(rows).index("text")
            out.writerow(["input", "n"])
            for row in rows:
                if "&&&" in row[place]:
                    print("bad row", file=sys.stderr, flush=True)
                    os._exit(1)
                out.writerow([row[place], len(row[place])])
        os._exit(0)
    print(target, os.waitstatus_to_exitcode(os.waitpid(run, 0)[1]), sep="\\t", flush=True)
"""


@_query(f"SELECT doc_id, status, CASE status WHEN 'OK' THEN length(text)::VARCHAR ELSE '' END AS n, CASE status WHEN 'FAIL' THEN 'EXIT 1: bad row' WHEN 'SKIP' THEN 'empty' ELSE '' END AS details FROM ({_V})")
def Q55_command_model(spark, d):
    """A command run on each chunk's file, and on files of parts where it exits with a code; its runs share a start."""
    # The command needs no installed packages, and does not look for them at each start.
    command = Command(("{python}", "-I", "-S", "-c", _COMMAND), "text", stays=True)
    scored, _ = models.score_spread(_many(spark, d), "text", command, ["n"], seconds=120, carry=("doc_id",))
    return scored.select("doc_id", "status", "n", "details")


@_query(f"""WITH {_F} SELECT chunk_no, idx::BIGINT AS idx, CASE WHEN idx BETWEEN 20 AND 24 THEN 'narrow' WHEN idx BETWEEN 10 AND 29 THEN 'middle' WHEN idx BETWEEN 40 AND 44 THEN 'part' ELSE 'whole' END AS by_, p_brand
FROM n WHERE chunk_no < (SELECT max(chunk_no) FROM n) AND (idx < 35 OR idx BETWEEN 40 AND 44)""")
def Q56_overlapping_fragments(spark, d):
    """Of each whole chunk a result that broke off after 35 rows, and complete and partial ones of ranges
    in it: one row for each index that any covers, by the fragment that counts there."""
    path, rows = _folder(spark), _parts(spark, d)
    last = rows.agg(F.max("chunk_no").alias("_last"))
    rows = rows.join(last, F.col("chunk_no") < F.col("_last")).drop("_last")
    for label, start, end, most in (("whole", 0, 49, 34), ("middle", 10, 29, 29), ("narrow", 20, 24, 24), ("part", 40, 48, 44)):
        some = rows.where((F.col("idx") >= start) & (F.col("idx") <= most)).withColumn("by_", F.lit(label))
        _ranges_as_files(some, path, label, F.lit(start), F.lit(end), "by_", "p_brand")
    return fragments.merge_fragments(_read_ranges(spark, path), "chunk_no").select("chunk_no", "idx", "by_", "p_brand")


@_query("""SELECT c AS chunk_no, doc_id::VARCHAR AS doc_id, CASE WHEN c % 3 < 2 THEN source ELSE '' END AS source, CASE WHEN c % 3 = 1 THEN lang ELSE '' END AS lang, CASE WHEN c % 3 = 2 THEN n_chars::VARCHAR ELSE '' END AS n_chars
FROM (SELECT *, ((row_number() OVER (ORDER BY doc_id) - 1) // 50)::INT AS c FROM documents)""")
def Q57_open_schemas(spark, d):
    """Result files of three headers, read as one table in one scan."""
    path = _folder(spark)
    docs = chunking.chunk(_t(spark, d, "documents").select("doc_id", "source", "lang", "n_chars"), "doc_id", size=50)
    for k, names in enumerate((("doc_id", "source"), ("source", "lang", "doc_id"), ("n_chars", "doc_id"))):
        chunk_sink.export_files(docs.where(F.col("chunk_no") % 3 == k), path, f"header{k}", F.format_string("m_results_%03d.csv", "chunk_no"), "idx", *names)
    return text_files.read_chunks(spark, path).select("chunk_no", "doc_id", "source", "lang", "n_chars")


@_query("""SELECT o_orderkey::VARCHAR AS o_orderkey, CASE o_custkey % 8 WHEN 3 THEN 'second' ELSE 'first' END AS load FROM orders WHERE o_custkey % 8 <> 5 AND (o_custkey % 8 <> 3 OR o_orderkey % 2 = 0)""")
def Q58_changed_files(spark, d):
    """CSV files read twice: between, one was written anew with half its rows, one deleted and one added."""
    root, rows = _folder(spark), _t(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 8).cast("int").alias("chunk_no"), F.lit("first").alias("load"))
    read = incremental.csv_rows(["o_orderkey", "load"])
    name = F.format_string("orders_%d.csv", "chunk_no")
    chunk_sink.export_files(rows.where("chunk_no <> 7"), f"{root}/in", "first", name, "o_orderkey", "o_orderkey", "load")
    incremental.ingest_files(spark, f"{root}/in", f"{root}/out", read)
    again = rows.where("chunk_no = 3 and o_orderkey % 2 = 0").withColumn("load", F.lit("second")).union(rows.where("chunk_no = 7"))
    chunk_sink.export_files(again, f"{root}/in", "second", name, "o_orderkey", "o_orderkey", "load")
    store, folder = chunk_sink.store_of(f"{root}/in")
    store.delete_file(f"{folder}/orders_5.csv")
    incremental.ingest_files(spark, f"{root}/in", f"{root}/out", read)
    return incremental.ingested(spark, f"{root}/out").select("o_orderkey", "load")


@_query("""SELECT doc_id // 20 AS chunk, CASE WHEN doc_id // 20 % 9 = 4 THEN 'MISSING' WHEN bool_or(doc_id % 97 = 7) THEN 'STALE' ELSE 'VALID' END AS status FROM documents GROUP BY 1""")
def Q59_stale_results(spark, d):
    """Results of chunks of which some have been overwritten since, and some have none."""
    now = _t(spark, d, "documents").select(F.expr("doc_id div 20").alias("chunk"), "doc_id", "text", "lang")
    then = now.where("chunk % 9 <> 4").withColumn("text", F.when(F.col("doc_id") % 97 == 7, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    kept = materialize(reconcile.fingerprint(then, ["doc_id", "text", "lang"], "chunk"), "fingerprints")
    return reconcile.validity(reconcile.fingerprint(now, ["doc_id", "text", "lang"], "chunk"), kept, "chunk")


@_query("""SELECT c_custkey, CASE c_custkey % 10 WHEN 3 THEN 3 WHEN 5 THEN 1 ELSE 0 END::BIGINT AS tries, CASE c_custkey % 10 WHEN 3 THEN 'QUARANTINED' ELSE 'DONE' END AS state FROM customer""")
def Q60_attempts(spark, d):
    """Rows that fail always, at first or never, run until none is due."""
    target, rows, turn = f"{_folder(spark)}/attempts", _t(spark, d, "customer").select("c_custkey"), 0

    def run(due):
        bad = (F.col("c_custkey") % 10 == 3) | (F.lit(turn == 0) & (F.col("c_custkey") % 10 == 5))
        return due.select("c_custkey", (~bad).alias("ok"), F.when(bad, "refused").otherwise("").alias("details"))

    while incremental.attempt(rows, "c_custkey", run, target):
        turn += 1
    return incremental.attempt_states(rows, "c_custkey", spark.read.parquet(target)).select("c_custkey", "tries", "state")


@_query(f"""SELECT doc_id, chunk_no, status, n, CASE WHEN fresh THEN 'second' ELSE 'first' END AS run FROM (
SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 100)::INT AS chunk_no, status, CASE status WHEN 'OK' THEN length(text)::VARCHAR ELSE '' END AS n FROM ({_V}))
JOIN (SELECT chunk_no, chunk_no % 4 = 1 OR bool_or(doc_id % 301 = 2) AS fresh FROM (SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 100)::INT AS chunk_no FROM documents) GROUP BY 1) USING (chunk_no)""")
def Q61_results_up_to_date(spark, d):
    """A model run twice: between, chunks came and some rows changed; only those chunks are run again."""
    target = f"{_folder(spark)}/results"
    docs = chunking.chunk(_t(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id", size=100)
    before = docs.where("chunk_no % 4 <> 1").withColumn("text", F.when(F.col("doc_id") % 301 == 2, F.concat("text", F.lit("!"))).otherwise(F.col("text")))

    def tagged(run):
        return lambda values: length_model(values).assign(run=run)

    for rows, run in ((before, "first"), (docs, "second")):
        runs.bring_up_to_date(rows, target, "text", tagged(run), ["n", "run"], carry=("doc_id",))
    found = runs.results(spark, target)
    # Rows that fail or are skipped have no model's columns: their chunk tells the run.
    ran = found.where("run <> ''").groupBy("chunk_no").agg(F.min("run").alias("run"))
    return found.drop("run").join(ran, "chunk_no").select("doc_id", "chunk_no", "status", "n", "run")
