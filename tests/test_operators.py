import bz2
import csv
import gzip
import io
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chunklake.functions.text import all_empty, label, number_in, strip
from chunklake.operators import chunking, merge, models, reconcile
from chunklake.operators.columns import detect, extract, resolve, result_columns
from chunklake.sources import archive, chunk_sink, open_files, text_files
from chunklake.sources.archive import Layout, read_archive
from chunklake.streaming import incremental


def test_resolve_prefers_the_exact_name_and_strips():
    assert resolve(["smiles", "SMILES"], "SMILES") == "SMILES"
    assert resolve(["smiles", "Catalog ID"], "CATALOG ID") == "Catalog ID"
    assert resolve([" SMILES ", "x"], "smiles") == " SMILES "
    assert resolve(["﻿SMILES"], "SMILES") == "﻿SMILES"
    assert resolve(["a"], "b") is None
    assert result_columns(["Key", " input", "x", "SMILES"]) == ["x"]


def test_structure_columns_are_found_by_name():
    assert detect(["id", " SMILES ", "input"]) == " SMILES " and detect(["Input", "canonical_smiles"]) == "Input"
    assert detect(["id", "name"]) is None and detect([]) is None and detect(["x", "Name"], ("name",)) == "Name"


def test_members_by_their_suffixes(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for name in ("b.TXT.GZ", "a.txt.gz", "c.txt", "__MACOSX/d.txt.gz", "e/f.txt.gz", "dir.txt.gz/"):
            z.writestr(name, b"x")
    names = lambda layout: [m.name for m in archive.members(str(tmp_path / "a.zip"), layout)]
    assert names(Layout("each", ",", "s", "i", (".txt.gz",))) == ["a.txt.gz", "b.TXT.GZ", "e/f.txt.gz"]
    assert names(Layout("largest", ",", "s", "i", (".none",))) == [] and len(names(Layout("largest", ",", "s", "i"))) == 1


def test_extract_drops_blank_rows_and_fills_a_missing_id(spark):
    df = spark.createDataFrame([(" C ",), (" \x1c",), (None,), ("",)], "smiles string")
    assert [tuple(r) for r in extract(df, "SMILES", "nothing").collect()] == [("C", "")]
    some, none = (extract(df, name, None, F.col("smiles").alias("raw"), F.lit(1).alias("member")) for name in ("smiles", "nothing"))
    assert none.columns == some.columns and none.count() == 0 and some.count() == 1


def test_strip_agrees_with_python(spark):
    values = [chr(c) + "a" + chr(c) for c in [*range(1, 0x250), *range(0x1680, 0x1690), *range(0x2000, 0x2070), 0x3000]]
    got = spark.createDataFrame([(v,) for v in values], "v string").select("v", strip(F.col("v")).alias("s")).collect()
    assert all(r.s == r.v.strip() for r in got)


def test_labels_and_numbers(spark):
    got = spark.createDataFrame([(7, "x_chunk_007.csv"), (1000, "chunk_1000.csv"), (1, "x_chunk_1.checkpoint.csv")], "n int, f string")
    assert [tuple(r) for r in got.select(label(F.col("n")), number_in(F.col("f"))).collect()] == [("007", 7), ("1000", 1000), ("001", None)]


def test_all_empty(spark):
    df = spark.createDataFrame([("", " "), ("", "x"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(all_empty([F.col("a"), F.col("b")])).collect()] == [True, False, True]
    assert [r[0] for r in df.select(all_empty([F.col("b")], stripped=False)).collect()] == [False, False, True]
    assert df.select(all_empty([])).first()[0] is False and df.select(all_empty([], vacuous=True)).first()[0] is True


@pytest.mark.parametrize("n", [0, 1, 9, 25, 1001])
def test_chunks_are_exact(spark, n):
    df = spark.createDataFrame([(i * 3,) for i in range(n)], "k long").repartition(3)
    got = chunking.chunk(df, "k", size=10).orderBy("k").collect()
    assert [(r.chunk_no, r.idx) for r in got] == [(i // 10, i % 10) for i in range(n)]


@pytest.mark.parametrize("n", [1, 9, 10, 11, 25, 100])
def test_splits_tile_a_range(spark, n):
    got = chunking.split_ranges(spark.createDataFrame([(0, n - 1)], "start long, end long")).orderBy("start").collect()
    assert [i for r in got for i in range(r.start, r.end + 1)] == list(range(n)) and len(got) <= 10
    assert len(got) == {11: 6, 25: 9}.get(n, min(n, 10))


def test_reconcile(spark):
    e, a = (spark.createDataFrame([(x,) for x in s], "k string") for s in (["1", "2", "2", "3"], ["2", "4"]))
    assert sorted(r.k for r in reconcile.missing(e, a, "k").collect()) == ["1", "3"]
    assert [r.k for r in reconcile.present(e, a, "k").collect()] == ["2"]
    got = {r.k: r.status for r in reconcile.compare_counts(e, a, "k").collect()}
    assert got == {"1": "MISSING", "2": "MISMATCH", "3": "MISSING"}
    empty = reconcile.retention(spark.createDataFrame([], "g string, v string"), "g", F.col("v").isNotNull(), total=True)
    assert [r.retention_pct for r in empty.collect()] in ([], [0.0])


def test_merge_by_name(spark):
    a, b = spark.createDataFrame([("1", "2")], "x string, y string"), spark.createDataFrame([("4", "3")], "y string, x string")
    assert [tuple(r) for r in merge.by_name([a, b, b.select("x")]).collect()] == [("1", "2"), ("3", "4"), ("3", "")]
    with pytest.raises(ValueError):
        merge.by_name([a.select("x"), b])


@pytest.mark.parametrize("n", [1, 9, 10, 11, 25, 100])
@pytest.mark.parametrize("fanout", [2, 10])
def test_poison_is_isolated(n, fanout):
    def model(values):
        if any("bad" in v for v in values):
            raise ValueError("bad\nrow")
        return pd.DataFrame({"n": [len(v) for v in values]})

    for bad in [set(), {0}, {n - 1}, {n // 2, min(n // 2 + 1, n - 1)}, set(range(n))]:
        values = ["bad" if i in bad else "x" * (i + 1) for i in range(n)]
        got = models.isolate(model, values, ["n"], fanout)
        assert [s == models.FAIL for s in got["status"]] == [i in bad for i in range(n)]
        assert got["n"].tolist() == ["" if i in bad else str(i + 1) for i in range(n)]
        assert all(d == "bad | row" for d in got["details"][got["status"] == models.FAIL])


def test_blank_rows_are_skipped_and_lost_failures_reported():
    calls = []

    def model(values):
        calls.append(values)
        if len(values) > 1:
            raise ValueError("only alone")
        return pd.DataFrame({"n": values})

    got = models.isolate(model, ["a", " ", "b"], ["n"])
    assert got["status"].tolist() == [models.UNREPRODUCED, models.SKIP, models.UNREPRODUCED]
    assert models.isolate(lambda v: pd.DataFrame({"n": []}), ["a"], ["n"])["status"].tolist() == [models.FAIL]


def test_csv_round_trip(spark, tmp_path):
    values = ["F/C=C\\F", 'a"b', "a,b", "a|b", " lead", "tail ", "two\nlines", ""]
    df = spark.createDataFrame([(v, str(i), i // 3, i % 3) for i, v in enumerate(values)], "smiles string, collection_id string, chunk_no int, idx int")
    text_files.write_chunks(df, f"file://{tmp_path}/out", "smiles", "collection_id")
    got = {}
    for f in sorted(tmp_path.glob("out/chunk_no=*/*.csv")):
        with f.open(newline="") as h:
            got |= {r["collection_id"]: r["smiles"] for r in csv.DictReader(h)}
    assert [got[str(i)] for i in range(len(values))] == values
    back = text_files.read_csv(spark, f"file://{tmp_path}/out")
    assert {r.collection_id: r.smiles for r in back.collect()} == got


def test_chunks_with_swapped_headers_are_united_by_name(spark, tmp_path):
    (tmp_path / "m_results_002.csv").write_text("b,a\n2,1\n")
    (tmp_path / "m_results_010.csv").write_text("a,b\n3,4\n")
    (tmp_path / "m_results_010.checkpoint.csv").write_text("a,b\n9,9\n")
    got = text_files.read_chunks(spark, f"file://{tmp_path}").orderBy("chunk_no").select("a", "b", "chunk_no").collect()
    assert [tuple(r) for r in got] == [("1", "2", 2), ("3", "4", 10)]
    assert {r["rows"] for r in text_files.physical_lines(spark, f"file://{tmp_path}").collect()} == {1}


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members:
            z.writestr(name, data)


def test_archives(spark, tmp_path):
    largest = Layout("largest", ",", "SMILES", "Catalog ID")
    _zip(tmp_path / "a.zip", [("__MACOSX/x.csv", "z" * 999), ("d/", ""), ("small.csv", "SMILES\nN\n"), ("big.csv", 'sep=,\r\nsmiles ,CATALOG ID\r\n"C,C",1\r\n  ,2\r\nO\r\n')])
    assert [tuple(r) for r in read_archive(spark, str(tmp_path / "a.zip"), largest).orderBy("row").collect()] == [("C,C", "1", 0, 0), ("O", "", 0, 2)]
    each = Layout("each", "\t", "S", "I", (".txt.gz",))
    _zip(tmp_path / "b.zip", [(f"{n}.txt.gz", gzip.compress(f"I\tS\n{n}\tC{n}\n".encode())) for n in "cab"])
    assert [r.smiles for r in read_archive(spark, str(tmp_path / "b.zip"), each).orderBy("member", "row").collect()] == ["Ca", "Cb", "Cc"]
    (tmp_path / "c.bz2").write_bytes(bz2.compress(b"smiles\tid\nC\\C\t7\n"))
    assert read_archive(spark, str(tmp_path / "c.bz2"), Layout("whole", "\t", "smiles", "id")).first()[:2] == ("C\\C", "7")
    _zip(tmp_path / "d.zip", [("x.csv", "a,b\n1,2\n")])
    assert read_archive(spark, str(tmp_path / "d.zip"), largest).count() == 0
    assert io.StringIO("").read() == ""


def test_streaming_reads_new_files_once(spark, tmp_path):
    src, out, ck = (f"file://{tmp_path}/{x}" for x in ("src", "out", "ck"))
    for i in range(2):
        spark.createDataFrame([(i,)], "k int").write.mode("append").parquet(src)
        incremental.ingest(spark, src, "k int", out, ck, lambda s: s.withColumn("d", F.col("k") * 2)).awaitTermination()
        assert spark.read.parquet(out).count() == i + 1


def test_resume_equals_one_run(spark, tmp_path):
    rows = spark.range(10).withColumnRenamed("id", "idx")
    target = f"file://{tmp_path}/done"
    rows.where("idx < 4").withColumn("v", F.col("idx") * 2).write.parquet(target)
    left = incremental.resume(rows, spark.read.parquet(target), "idx", lambda p: p.withColumn("v", F.col("idx") * 2), target)
    assert left.count() == 0
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == [(i, 2 * i) for i in range(10)]


def test_gaps_and_uncovered(spark):
    ranges = spark.createDataFrame([("a", 2, 4), ("a", 3, 3), ("a", 8, 9), ("b", 0, 9)], "k string, start long, end long")
    sizes = spark.createDataFrame([("a", 12), ("b", 10), ("c", 3), ("d", 0)], "k string, size long")
    assert sorted(tuple(r) for r in merge.gaps(ranges, sizes, "k").collect()) == [("a", 0, 1), ("a", 5, 7), ("a", 10, 11), ("c", 0, 2)]
    rows = spark.range(6).withColumnRenamed("id", "idx")
    assert sorted(r.idx for r in merge.uncovered(rows, ranges.where("k = 'a'"), 12).collect()) == [0, 1, 5]


def test_preview_counts_nulls_apart(spark):
    rows = spark.createDataFrame([("a", i) for i in range(30)] + [("b", None), (None, 5)], "g string, i int")
    got = {r.g: (r["items"], r.more) for r in reconcile.preview(rows, "g", "i").collect()}
    assert got == {"a": (list(range(20)), 10), "b": ([], 0), None: ([5], 0)}


def test_report_and_status(spark):
    inputs = spark.createDataFrame([("L", 0), ("L", 0), ("L", 1), ("M", 0)], "lib string, chunk int")
    outputs = spark.createDataFrame([("L", 0, "x"), ("M", 0, "")], "lib string, chunk int, v string")
    got = {r.lib: tuple(r)[1:] for r in reconcile.report(inputs, outputs, "lib", "chunk", F.col("v") != "").collect()}
    assert got == {"L": (2, 1, 1, 3, 1, 0), "M": (1, 0, 0, 1, 1, 1), None: (3, 1, 1, 4, 2, 1)}
    status = reconcile.run_status(inputs, inputs.where("lib = 'L'"), outputs.limit(0), "lib")
    assert {r.lib: r.status for r in status.collect()} == {"L": "NO_RESULTS", "M": "NO_OUTPUT_DIR"}


def test_time_limits():
    import time

    def model(values):
        if "slow" in values:
            time.sleep(20)
        if "die" in values:
            raise ValueError("no\nway")
        return pd.DataFrame({"n": values})

    got = models.isolate(model, ["a", "slow", "b", "die"], ["n"], seconds=0.5)
    assert got["status"].tolist() == ["OK", "FAIL", "OK", "FAIL"] and got["details"].tolist() == ["", "TIMEOUT after 0.5 s", "", "no | way"]


def test_sep_lines_and_ragged_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfSEP=;\r\nsmiles;id;x\r\nC;1\r\n\r\n;2;y\r\nN;3;z;more\r\n")
    assert [tuple(r) for r in text_files.read_csv(spark, f"file://{tmp_path}/a.csv").collect()] == [("C", "1", ""), ("", "2", "y"), ("N", "3", "z")]
    (tmp_path / "b.csv").write_text("smiles,id\nC\n")
    assert [tuple(r) for r in text_files.first_column(text_files.read_csv(spark, f"file://{tmp_path}/b.csv"), "s").collect()] == [("C",)]
    # Only the first line and the header are no data, in whichever file they are.
    (tmp_path / "c.csv").write_text('sep=;\na;b\na;b\nsep=x;1\n"two\nlines";2\n')
    got = text_files.read_csv(spark, [f"file://{tmp_path}/b.csv", f"file://{tmp_path}/c.csv"])
    assert sorted(map(tuple, got.select("a", "b", "smiles", "id").collect())) == [("", "", "C", ""), ("a", "b", "", ""), ("sep=x", "1", "", ""), ("two\nlines", "2", "", "")]
    (tmp_path / "none.csv").write_text("")
    assert text_files.read_csv(spark, [f"file://{tmp_path}/none.csv", f"file://{tmp_path}/c.csv"]).count() == 3


def test_files_of_any_header_are_one_table(spark, tmp_path):
    heads = (("a", "b"), ("b", "c", "a"), ("d e.f'\"", "a"))
    for i in range(1001):
        names = heads[i % 3]
        with (tmp_path / f"m_results_{i:03d}.csv").open("w", newline="") as f:
            csv.writer(f).writerows([names, *([f"{n}{i}-{k}" for n in names] for k in range(i % 4))])
    path = f"file://{tmp_path}"
    got = text_files.read_chunks(spark, path)
    assert set(got.columns) == {"a", "b", "c", "d e.f'\"", "chunk_no"}
    want = {(i, *[f"{n}{i}-{k}" if n in heads[i % 3] else "" for n in ("a", "b", "c", "d e.f'\"")]) for i in range(1001) for k in range(i % 4)}
    assert {(r["chunk_no"], r["a"], r["b"], r["c"], r["d e.f'\""]) for r in got.collect()} == want
    rows = open_files.open_rows(spark, path)
    assert rows.count() == len(want)
    schema = open_files.merged_schema(rows).first().schema
    assert all(f"{n}: STRING" in schema for n in "abc")
    by_file = open_files.merged_schema(rows.where("path like '%_003.csv' or path like '%_001.csv'"), "path").collect()
    assert {r.path[-7:-4]: r.schema for r in by_file} == {"003": "OBJECT<a: STRING, b: STRING>", "001": "OBJECT<a: STRING, b: STRING, c: STRING>"}


def test_exported_chunks_are_those_of_the_csv_module(spark, tmp_path):
    rows = spark.createDataFrame([(0, 0, ' a"b'), (0, 1, ""), (1000, 0, "F/C=C\\F")], "chunk_no int, idx int, smiles string")
    chunk_sink.export_chunks(rows, f"file://{tmp_path}", "lib", "smiles", labels=spark.createDataFrame([(0,), (7,)], "chunk_no int"))
    for name, values in (("000", [' a"b', ""]), ("007", []), ("1000", ["F/C=C\\F"])):
        with io.StringIO(newline="") as want:
            writer = csv.writer(want)
            writer.writerows([["smiles"], *([v] for v in values)])
            assert (tmp_path / f"lib_chunk_{name}.csv").read_bytes() == want.getvalue().encode()
    assert sorted(p.name for p in tmp_path.glob("*.csv")) == ["lib_chunk_000.csv", "lib_chunk_007.csv", "lib_chunk_1000.csv"]
    assert {r.chunk_no for r in text_files.chunk_numbers(spark, f"file://{tmp_path}").collect()} == {0, 7, 1000}
    assert text_files.first_file(spark, f"file://{tmp_path}").endswith("lib_chunk_000.csv") and text_files.first_file(spark, f"file://{tmp_path}/none") is None


def test_archives_behind_a_uri_and_other_suffixes(spark, tmp_path):
    _zip(tmp_path / "a.zip", [("x.smiles", "SMILES,Catalog ID\nC,1\n")])
    layout = Layout("largest", ",", "SMILES", "Catalog ID")
    assert read_archive(spark, f"file://{tmp_path}/a.zip", layout).first()[:2] == ("C", "1")
    (tmp_path / "b.csv").write_text("sep=,\nSMILES,Catalog ID\nN,2\n")
    assert read_archive(spark, f"file://{tmp_path}/b.csv", Layout("whole", ",", "SMILES", "Catalog ID")).first()[:2] == ("N", "2")


def test_checkpoint_rows_and_retries(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a", 0), (" 1 ", "b", 1), ("x", "c", 2), (None, "d", 3), ("2", "e", 4)], "__idx__ string, v string, at int")
    assert sorted((r["__idx__"], r.v) for r in incremental.checkpoint_rows(rows, "at").collect()) == [(1, "b"), (2, "e")]
    work, target = spark.range(5).withColumnRenamed("id", "k"), f"file://{tmp_path}/t"
    work.limit(0).write.parquet(target)
    left, turns = incremental.until_complete(work, "k", lambda p: p.where("k <> 3"), target)
    assert [r.k for r in left.collect()] == [3] and turns == 2


def test_numbering_does_not_shuffle_rows_again(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = chunking.number(spark.range(1000).selectExpr("999 - id AS id"), "id")
        assert "SortMergeJoin" not in numbered._jdf.queryExecution().executedPlan().toString()
        assert all(r.id == r.ordinal for r in numbered.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
