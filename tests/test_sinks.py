import bz2
import csv
import zipfile

import pytest
from pyspark.sql import functions as F

from chunklake.sources import sinks
from chunklake.sources.archive import Layout
from chunklake.sources.catalog import Catalogue


def test_catalogue(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.csv", "S,I,J\nC,1,2\n")
    known = Catalogue({"a.zip": ("A", "f")}, {"f": Layout("largest", ",", "S", "I")}, {"a.zip": ("S", "J")}, {"Ay": "A"})
    with pytest.warns(UserWarning):
        got = known.read(spark, str(tmp_path), ["a.zip", "b.zip"]).collect()
    assert [(r.library, r.smiles, r.collection_id) for r in got] == [("A", "C", "2")]
    (tmp_path / "c.bz2").write_bytes(bz2.compress(b"other\tid\nC\t7\n"))
    known.files["c.bz2"], known.formats["w"] = ("B", "w"), Layout("whole", "\t", "S", "id")
    assert [r.library for r in known.read(spark, str(tmp_path)).collect()] == ["A"]  # the other has no structures
    assert known.library("aY") == "A" and known.library("B") == "B"


def _read(path):
    return [r for f in sorted(path.glob("part-*")) for r in list(csv.reader(f.open(newline="")))[1:]]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(n, f"{n:03d}", 0, f"v{n}", "") for n in (1000, 101, 2)], "chunk_no int, chunk_label string, idx int, a string, b string")
    out = f"file://{tmp_path}/m"
    assert sinks.write_merged(rows, out, "a", "b", dry_run=True).count() == 3 and not (tmp_path / "m").exists()
    sinks.write_merged(rows, out, "a", "b")
    assert _read(tmp_path / "m") == [["v2", ""], ["v101", ""], ["v1000", ""]]
    sinks.write_merged(rows, out, "a", "b", order="lexical")
    assert _read(tmp_path / "m") == [["v2", ""], ["v1000", ""], ["v101", ""]]
    scored = spark.createDataFrame([("L", "f", 1, "C", "FAIL", "why"), ("L", "f", 0, "N", "OK", "")], "library string, chunk_file string, idx int, smiles string, status string, details string")
    sinks.write_report(scored, f"file://{tmp_path}/r")
    assert _read(tmp_path / "r") == [["L", "f", "1", "N", "OK", ""], ["L", "f", "2", "C", "FAIL", "why"]]
    sinks.write_index(rows, f"file://{tmp_path}/i", "a", "chunk_no")
    assert "".join(f.read_text() for f in sorted((tmp_path / "i").glob("part-*"))).split() == ["v2", "v101", "v1000"]
    for n in range(2):
        sinks.log_run(spark, f"file://{tmp_path}/runs", library="L", rows=n)
    assert spark.read.parquet(f"file://{tmp_path}/runs").where(F.col("facts")["library"] == "L").count() == 2
