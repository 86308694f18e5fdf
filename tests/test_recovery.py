"""Commands, time limits, isolation over the cluster, attempts, and results that must be whole or not there."""

import os
import random
import subprocess
import sys
import threading
import time
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chunklake.functions import text
from chunklake.operators import fragments, models, reconcile, runs
from chunklake.operators.runners import Command, ModelFailure, trials
from chunklake.plans import catalogue
from chunklake.sources import chunk_sink, open_files, published, shared
from chunklake.sources.archive import Layout, archives_of
from chunklake.streaming import incremental, progress


def command(code, **options):
    return Command((sys.executable, "-c", "import csv, os, sys, time\nrows = list(csv.DictReader(open(sys.argv[1], newline='')))\n" + code, "{input}", "{output}"), **options)


COPY = "out = csv.writer(open(sys.argv[2], 'w', newline=''))\nout.writerow(['key', 'n', 'SMILES', 'e'])\nfor r in rows: out.writerow(['k', len(r['smiles']), r['smiles'], ''])\n"


def run(model, values, seconds=None):
    with trials(model, seconds) as trial:
        return trial(values)


def test_commands_give_result_columns():
    values = ['a"b', " c,d ", "two\nlines", "e\r\n", "ü"]
    out, why = run(command(COPY), values)
    assert why == "" and list(out.columns) == ["n", "e"]
    assert out["n"].tolist() == [str(len(v)) for v in values] and out["e"].tolist() == [""] * 5


@pytest.mark.parametrize(
    ("code", "why"),
    [
        ("sys.exit(3)", "EXIT 3:"),
        ("sys.exit('no\\nway')", "EXIT 1: no | way"),
        (COPY + "out = None\nsys.exit(7)", "EXIT 7:"),  # whole output, but a failure
        ("open(sys.argv[2], 'w').write('n\\n1\\n')", "3 rows in, 1 out"),
        ("pass", "EXIT 0: no output"),
        ("open(sys.argv[2], 'w')", "3 rows in, 0 out"),
        ("os.kill(os.getpid(), 9)", "EXIT -9:"),
        (COPY + "time.sleep(60)", "TIMEOUT after 0.7 s"),
    ],
)
def test_failing_commands_say_why(code, why):
    out, said = run(command(code), ["a", "b", "c"], 0.7 if "sleep" in code else 30)
    assert out is None and said.strip() == why


def _alive(pid):
    try:
        return Path(f"/proc/{pid}/stat").read_text().rpartition(")")[2].split()[0] != "Z"
    except FileNotFoundError:
        return False


@pytest.mark.parametrize("end", ["time.sleep(60)", COPY, "sys.exit(2)"])
def test_grandchildren_and_folders_go_with_the_command(tmp_path, end):
    spawn = f"import subprocess\np = subprocess.Popen(['sleep', '60'])\nopen('{tmp_path}/pid', 'w').write(str(p.pid))\nopen('{tmp_path}/folder', 'w').write(os.getcwd())\n"
    began = time.time()
    run(command(spawn + end), ["a"], 2)
    assert time.time() - began < 20
    pid = int((tmp_path / "pid").read_text())
    for _ in range(100):
        if not _alive(pid):
            break
        time.sleep(0.05)
    assert not _alive(pid) and not os.path.exists((tmp_path / "folder").read_text())


def test_a_command_that_is_not_there():
    out, why = run(Command(("/nowhere/at/all", "{input}")), ["a"])
    assert out is None and "/nowhere/at/all" in why


def test_python_models_under_a_limit(tmp_path):
    def model(values):
        import os
        import time

        print("noise")
        if "slow" in values:
            time.sleep(30)
        if "exit" in values:
            os._exit(4)
        if "bad" in values:
            raise ValueError("bad\nrow")
        return pd.DataFrame({"pid": [os.getpid()] * len(values)})

    with trials(model, 1) as trial:
        first, again = trial(["a", "b"])[0]["pid"].tolist(), trial(["c"])[0]["pid"].tolist()
        assert first == [first[0]] * 2 and again == first[:1] and first[0] != os.getpid()
        assert trial(["bad"]) == (None, "bad | row")
        assert trial(["slow"]) == (None, "TIMEOUT after 1 s")
        assert not _alive(first[0])
        assert trial(["exit"])[1] == "EXIT 4: the model ended without a result"
        last = trial(["d"])[0]["pid"][0]
    assert not _alive(last)


def test_failures_are_exceptions_of_the_model():
    with pytest.raises(ModelFailure, match="EXIT 5"):
        command("sys.exit(5)")(["a"])


# isolation


def _make_model():
    """A function that goes to the workers by value."""

    def model(values):
        if any(v.startswith("bad") for v in values):
            raise ValueError("bad row")
        if sum(v.startswith("pair") for v in values) > 1:
            raise ValueError("together")
        return pd.DataFrame({"n": [len(v) for v in values]})

    return model


@pytest.mark.parametrize("fanout", [2, 10])
def test_spread_isolation_is_that_of_a_task(spark, fanout):
    rng, _model = random.Random(fanout), _make_model()
    rows, want = [], {}
    for lib, chunk, n in (("L", 0, 100), ("L", 1, 37), ("M", 0, 11), ("M", 1, 1), ("M", 2, 25), ("M", 3, 6)):
        values = [rng.choice(["x" * rng.randint(1, 9)] * 12 + ["bad", "", " ", "pair"]) for _ in range(n)]
        if chunk == 2:
            values = ["ok"] * 3 + ["pair"] + ["ok"] * 10 + ["pair"] + ["ok"] * 10  # fails as a whole only, or in one part
        if (lib, chunk) == ("M", 3):
            values = [" "] * 6
        rows += [(lib, chunk, i, v, i * 7) for i, v in enumerate(values)]
        alone = models.isolate(_model, values, ["n"], fanout)
        want |= {(lib, chunk, i): tuple(alone.iloc[i][["n", "status", "details"]]) for i in range(n)}
    df = spark.createDataFrame(rows, "lib string, chunk_no int, idx int, v string, id int").repartition(5)
    scored, log = models.score_spread(df, "v", _model, ["n"], keys=("lib", "chunk_no"), fanout=fanout, carry=("id",))
    assert {(r.lib, r.chunk_no, r.idx): (r.n, r.status, r.details) for r in scored.collect()} == want
    assert {s for _, s, _ in want.values()} == {"OK", "FAIL", "SKIP", "UNREPRODUCED"}
    tried = log.collect()
    assert len({(r["round"], r.task) for r in tried}) > 4 and len({r.task for r in tried if r["round"] == 1}) > 1
    assert all((r.end - r.start + 1) == r.rows for r in tried)
    none, log = models.score_spread(df.limit(0), "v", _model, ["n"], keys=("lib", "chunk_no"))
    assert none.count() == 0 and log.count() == 0


def test_commands_are_isolated_over_the_cluster(spark):
    df = spark.createDataFrame([(0, i, "bad" if i in (3, 17) else f"v{i}") for i in range(20)], "chunk_no int, idx int, v string")
    scored, _ = models.score_spread(df, "v", command("any(r['smiles'] == 'bad' for r in rows) and sys.exit('bad row')\n" + COPY), ["n"], seconds=60)
    got = {r.idx: (r.n, r.status, r.details) for r in scored.collect()}
    assert got == {i: ("", "FAIL", "EXIT 1: bad row") if i in (3, 17) else (str(len(f"v{i}")), "OK", "") for i in range(20)}


def test_the_end_of_a_command_is_told_and_not_asked_for(monkeypatch):
    ours, sleep = threading.current_thread(), time.sleep
    monkeypatch.setattr(time, "sleep", lambda s: pytest.fail("asks again and again") if threading.current_thread() is ours else sleep(s))
    out, why = run(command(COPY), ["a"], 30)
    assert why == "" and out["n"].tolist() == ["1"]
    assert run(command("time.sleep(60)"), ["a"], 0.2) == (None, "TIMEOUT after 0.2 s")


def test_ranges_of_a_task_share_its_process(spark):
    def model(values):
        import os

        if "bad" in values:
            raise ValueError("bad row")
        return pd.DataFrame({"pid": [os.getpid()] * len(values)})

    df = spark.createDataFrame([(c, i, "bad" if i == 3 else f"v{i}") for c in range(40) for i in range(20)], "chunk_no int, idx int, v string")
    scored, log = models.score_spread(df, "v", model, ["pid"], seconds=60)
    tasks, trials = log.select("round", "task").distinct().count(), log.count()
    assert scored.where("status = 'OK'").select("pid").distinct().count() <= tasks < trials / 4


@pytest.mark.parametrize("most", [1, 7])
def test_ranges_that_go_over_batches(spark, most):
    model = _make_model()
    values = {c: [random.Random(c).choice(["x", "yy", "zzz", "bad", "pair", " "]) for _ in range(n)] for c, n in enumerate((30, 7, 1, 50, 14))}
    df = spark.createDataFrame([(c, i, v) for c, held in values.items() for i, v in enumerate(held)], "chunk_no int, idx int, v string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
    try:
        got = {(r.chunk_no, r.idx): (r.n, r.status, r.details) for r in models.score_spread(df, "v", model, ["n"])[0].collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {c: models.isolate(model, held, ["n"]) for c, held in values.items()}
    assert got == {(c, i): tuple(want[c].iloc[i][["n", "status", "details"]]) for c, held in values.items() for i in range(len(held))}


def test_ranges_of_the_first_round_are_not_kept_once_tried(spark):
    def folders():
        return set(Path(shared.shared_dir(spark).removeprefix("file:"), "chunklake", spark.sparkContext.applicationId).glob("work-*"))

    kept = folders()
    df = spark.createDataFrame([(0, i, "bad" if i == 3 else " " if i == 5 else "v") for i in range(20)], "chunk_no int, idx int, v string")
    scored, log = models.score_spread(df, "v", _make_model(), ["n"])
    assert folders() - kept == set()
    assert {(r.status, r["count"]) for r in scored.groupBy("status").count().collect()} == {("OK", 18), ("FAIL", 1), ("SKIP", 1)} and log.count() > 1


def test_blank_is_what_strip_leaves_nothing_of(spark):
    ends = [chr(c) for c in [*range(0x20), 0x20, 0x7F, 0x85, 0xA0, 0xAD, 0x1680, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF, 0x1F600]]
    values = [None, "", "a", *ends, *(f"{e}\n" for e in ends), *(f"{e}a " for e in ends), *(f" \n{e}{e}" for e in ends)]
    found = spark.createDataFrame([(v,) for v in values], "v string").select("v", (text.strip(F.col("v")) == "").alias("want"), text.blank(F.col("v")).alias("got")).collect()
    assert [r.v for r in found if r.got is not r.want] == [] and {r.want for r in found} == {True, False}


# commands that stay


def staying(code, **options):
    """``code`` has a run's ``values`` and the names of its files."""
    loop = "import csv, os, sys, time\nfor line in sys.stdin:\n    source, target = line.rstrip('\\n').split('\\t')\n    values = [r['smiles'] for r in csv.DictReader(open(source, newline=''))]\n"
    return Command((sys.executable, "-c", loop + "".join(f"    {c}\n" for c in code)), stays=True, **options)


WRITE = ["with open(target, 'w', newline='') as f: csv.writer(f).writerows([['pid', 'n'], *([os.getpid(), len(v)] for v in values)])"]
ANSWER = ["print('noise'); print(target, flush=True)"]
READ = "'bad' in values and sys.exit('bad\\nrow')"


def test_a_command_that_stays_is_started_anew_only_where_it_has_ended():
    values = ['a"b', " c,d ", "two\nlines", "e\r\n", "ü"]
    with trials(staying(["print('for the', len(values), file=sys.stderr, flush=True)", READ, *WRITE, *ANSWER]), 30) as trial:
        first, again = trial(values)[0], trial(["b"])[0]
        assert first["n"].tolist() == [str(len(v)) for v in values] and again["pid"].tolist() == first["pid"].tolist()[:1]
        folder = os.readlink(f"/proc/{again['pid'][0]}/cwd")
        assert os.listdir(folder) == ["stderr.txt"]
        assert trial(["x", "bad"]) == (None, "EXIT 1: for the 2 | bad | row")  # nothing of the runs before
        assert not _alive(again["pid"][0]) and not os.path.exists(folder)
        last = trial(["c"])[0]["pid"][0]
        assert last != again["pid"][0] and _alive(last)
    assert not _alive(last)
    assert staying(WRITE + ANSWER)(["abc"])["n"].tolist() == ["3"]


@pytest.mark.parametrize(
    ("code", "why"),
    [
        (["sys.exit(3)"], "EXIT 3:"),
        ([*WRITE, "sys.exit(7)"], "EXIT 7:"),  # whole output, but a failure
        ([*WRITE, "sys.exit(0)"], "EXIT 0: no answer"),
        ([*WRITE, "os.close(1)"], "EXIT 0: no answer"),
        (["os.kill(os.getpid(), 9)"], "EXIT -9:"),
        (ANSWER, "EXIT 0: no output"),
        (["open(target, 'w').write('n\\n1\\n')", *ANSWER], "3 rows in, 1 out"),
        ([*WRITE, "time.sleep(60)"], "TIMEOUT after 0.7 s"),
        ([*WRITE, "while True: print('noise', flush=True)"], "TIMEOUT after 0.7 s"),
        (["import subprocess", "subprocess.Popen(['sleep', '60'])", "sys.exit(5)"], "EXIT 5:"),
    ],
)
def test_failing_commands_that_stay_say_why(code, why):
    began = time.time()
    with trials(staying(code), 0.7 if why.startswith("TIMEOUT") else 30) as trial:
        assert [trial(["a", "b", "c"]), trial(["a", "b", "c"])] == [(None, why)] * 2
    assert time.time() - began < 20


def test_a_command_that_stays_may_tell_codes_of_its_runs():
    work = ["run = os.fork()", "if not run:", f"    {READ}", "    'kill' in values and os.kill(os.getpid(), 9)", "    f = open(target, 'w', newline='')", "    csv.writer(f).writerows([['pid'], *([os.getppid()] for v in values)])", "    f.close()", "    os._exit(0)"]
    tell = ["print('noise\\t5'); print(target, os.waitstatus_to_exitcode(os.waitpid(run, 0)[1]), sep='\\t', flush=True)"]
    with trials(staying([*work, *tell]), 30) as trial:
        first = trial(["a", "b"])[0]["pid"].tolist()
        assert trial(["bad", "a"]) == (None, "EXIT 1: bad | row")
        assert trial(["kill"]) == (None, "EXIT -9:")
        assert trial(["c"])[0]["pid"].tolist() == first[:1] == first[1:]  # the command has gone on
        assert len(os.listdir(f"/proc/{first[0]}/cwd/")) == 1
    assert not _alive(first[0])


def test_commands_that_end_before_they_read_and_that_are_not_there():
    assert run(Command((sys.executable, "-c", "import sys; sys.exit('broken')"), stays=True), ["a" * 99], 30) == (None, "EXIT 1: broken")
    assert "/nowhere/at/all" in run(Command(("/nowhere/at/all",), stays=True), ["a"])[1]


def test_commands_that_stay_are_isolated_over_the_cluster(spark):
    df = spark.createDataFrame([(c, i, "bad" if i == 3 else f"v{i}") for c in range(40) for i in range(20)], "chunk_no int, idx int, v string")
    scored, log = models.score_spread(df, "v", staying([READ, *WRITE, *ANSWER]), ["n", "pid"], seconds=60)
    got = {(r.chunk_no, r.idx): (r.n, r.status, r.details) for r in scored.collect()}
    assert got == {(c, i): ("", "FAIL", "EXIT 1: bad | row") if i == 3 else (str(len(f"v{i}")), "OK", "") for c in range(40) for i in range(20)}
    ended = log.where("outcome <> 'OK'").count()
    assert scored.where("status = 'OK'").select("pid").distinct().count() <= ended + log.select("round", "task").distinct().count() < log.count()


def test_the_command_of_q55_is_not_started_for_each_trial(spark, sf_dir, monkeypatch):
    given, started, popen = [], [], subprocess.Popen
    monkeypatch.setattr(models, "score_spread", lambda chunked, value, model, columns, **more: given.append(model) or (chunked.selectExpr("doc_id", "'' AS status", "'' AS n", "'' AS details"), None))
    catalogue.QUERIES["Q55_command_model"](spark, sf_dir)
    monkeypatch.setattr(subprocess, "Popen", lambda *a, **b: started.append(a) or popen(*a, **b))
    values = [f"text {i}" + "&&&" * (i in (3, 250, 251, 499)) for i in range(500)]
    out = models.isolate(given[0], values, ["n"], seconds=120)
    assert out["status"].tolist() == ["FAIL" if "&&&" in v else "OK" for v in values] and out["n"].tolist() == ["" if "&&&" in v else str(len(v)) for v in values]
    assert out.loc[out["status"] == "FAIL", "details"].tolist() == ["EXIT 1: bad row"] * 4
    assert len(started) == 1  # for 1 + 10 + 3 * 10 + 3 * 5 trials, of which eleven fail


@pytest.mark.parametrize("model", [command(COPY), staying(WRITE + ANSWER)])
def test_a_temporary_folder_told_from_where_a_process_works(tmp_path, monkeypatch, model):
    monkeypatch.chdir(tmp_path)
    monkeypatch.setattr("tempfile.tempdir", "/proc/self/cwd")
    out, why = run(model, ["abc"], 30)
    assert why == "" and out["n"].tolist() == ["3"] and not list(tmp_path.iterdir())


# files that are whole or not there


def _batches(spark, rows):
    return spark.createDataFrame(rows, "_file string, _place long, v string").toArrow().to_batches()


def test_a_file_setting_loses_no_rows(spark, tmp_path):
    rows = spark.createDataFrame([(i // 25, i % 25, f"v{i}") for i in range(60)], "chunk_no int, idx int, v string").repartition(4)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "5")
    try:
        chunk_sink.export_chunks(rows, f"file://{tmp_path}/a", "lib", "v")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    for c, n in ((0, 25), (1, 25), (2, 10)):
        assert (tmp_path / f"a/lib_chunk_{c:03d}.csv").read_bytes().decode().split() == ["v", *[f"v{i}" for i in range(25 * c, 25 * c + n)]]
    assert chunk_sink.manifest(f"file://{tmp_path}/a", "lib") == {"label": "lib", "files": 3, "rows": 60}


def test_repeated_and_failed_tasks(spark, tmp_path):
    batches = _batches(spark, [("a/x.csv", 0, "1"), ("a/x.csv", 1, "2"), ("b.csv", None, ""), ("c.csv", 0, "3")])
    (tmp_path / "out").mkdir()
    (tmp_path / "out/old.csv").write_text("old")
    writer = chunk_sink.ChunkWriter({"path": f"file://{tmp_path}/out", "label": "L"}, ["_file", "_place", "v"], True)

    def broken():
        yield from batches
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(broken())
    assert (tmp_path / "out/old.csv").exists() and not list(tmp_path.rglob(".*"))
    first, second = writer.write(iter(batches)), writer.write(iter(batches))
    assert first == second and (second.files, second.rows) == (3, 3)
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["old.csv"]  # nothing is there before the commit
    writer.commit([None, second])
    found = {str(p.relative_to(tmp_path / "out")): p.read_bytes() for p in (tmp_path / "out").rglob("*") if p.is_file()}
    assert found == {"a/x.csv": b"v\r\n1\r\n2\r\n", "b.csv": b"v\r\n", "c.csv": b"v\r\n3\r\n", "_manifest-L.json": b'{"label": "L", "files": 3, "rows": 3}'}
    other = chunk_sink.ChunkWriter({"path": f"file://{tmp_path}/out", "label": "L"}, ["_file", "_place", "v"], True)
    other.write(iter(batches[:1]))
    other.abort([None])
    assert [p.name for p in tmp_path.iterdir()] == ["out"] and len(list((tmp_path / "out").iterdir())) == 4


def test_exports_beside_and_instead_of_each_other(spark, tmp_path):
    rows = spark.createDataFrame([(0, 0, "a"), (3, 0, None)], "chunk_no int, idx int, v string")
    for library in ("L", "M"):
        chunk_sink.export_chunks(rows, f"file://{tmp_path}/o", library, "v")
    assert len(list((tmp_path / "o").glob("*.csv"))) == 4
    chunk_sink.export_chunks(rows.limit(0), f"file://{tmp_path}/o", "L", "v", labels=rows.select("chunk_no"), replace=True)
    assert {p.name: p.read_text() for p in (tmp_path / "o").glob("*.csv")} == {"L_chunk_000.csv": "v\n", "L_chunk_003.csv": "v\n"}
    chunk_sink.export_chunks(rows.limit(0), f"file://{tmp_path}/n", "L", "v")
    assert chunk_sink.manifest(f"file://{tmp_path}/n", "L")["files"] == 0 and chunk_sink.manifest(f"file://{tmp_path}/x", "L") is None


def test_publishing(spark, tmp_path):
    target = f"file://{tmp_path}/t"
    assert published.newest(spark, target) is None and published.current(spark, target, "v long").count() == 0
    with pytest.raises(Exception, match="nothing has been published"):
        published.current(spark, target)
    assert published.publish(spark.range(3), target, by="me") == 1
    assert published.publish(spark.range(5), target, expect=1) == 2
    assert published.current(spark, target).count() == 5 and published.newest(spark, target)["version"] == 2
    with pytest.raises(published.Conflict):
        published.publish(spark.range(7), target, expect=1)
    (tmp_path / "t/_versions/00000003.json").write_text("")  # one that is being written
    assert published.current(spark, target).count() == 5
    with pytest.raises(published.Conflict):
        published.publish(spark.range(7), target)


# fragments


@pytest.mark.parametrize("seed", range(5))
def test_fragments_against_all_of_them_at_each_index(spark, seed):
    rng = random.Random(seed)
    rows, best = [], {}
    for chunk in range(4):
        for f in range(rng.randint(1, 12)):
            a = rng.randint(0, 30)
            b = a + rng.randint(0, 15)
            n = rng.choice([b - a + 1] * 2 + [rng.randint(0, b - a + 1), b - a + 3])
            rows += [(chunk, f"f{f}", a, b, a + i, f"{f}-{i}") for i in range(n)]
            for i in range(a, min(a + n, b + 1)):
                rank = (n != b - a + 1, b - a, a, f"f{f}")
                best[chunk, i] = min(best.get((chunk, i), (rank, f"{f}-{i - a}")), (rank, f"{f}-{i - a}"))
    df = spark.createDataFrame(rows, "chunk_no int, file string, start long, end long, idx long, v string").repartition(3)
    got = fragments.merge_fragments(df, "chunk_no").collect()
    assert len(got) == len(best) and {(r.chunk_no, r.idx): r.v for r in got} == {k: v for k, (_, v) in best.items()}
    sizes = spark.createDataFrame([(c, 50) for c in range(4)], "chunk_no int, size long")
    missing = {(r.chunk_no, i) for r in fragments.fragment_gaps(df, sizes, "chunk_no").collect() for i in range(r.start, r.end + 1)}
    assert missing == {(c, i) for c in range(4) for i in range(50)} - set(best)
    assert fragments.merge_fragments(df.limit(0), "chunk_no").count() == 0


def test_small_chunks_are_swept_by_many_tasks(spark):
    df = spark.createDataFrame([(c, "f", 0, 4, 3 + c % 2) for c in range(200)], "chunk_no int, file string, start long, end long, rows long")
    got = fragments.choose(df, "chunk_no").withColumn("task", F.spark_partition_id()).collect()
    assert {(r.chunk_no, r.file, r.first, r.last) for r in got} == {(c, "f", 0, 2 + c % 2) for c in range(200)} and len(got) == 200
    assert len({r.task for r in got}) > 4


def test_files_are_read_once_and_written_by_many_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(200).select(F.col("id").alias("chunk_no"), F.lit(0).alias("idx"), F.concat(F.lit("é,"), F.col("id").cast("string")).alias("v"), F.spark_partition_id().alias("t"))
    chunk_sink.export_files(rows.where("id < 100"), f"file://{tmp_path}/o", "a", F.format_string("d%d/m_results_%03d.csv", F.col("chunk_no") % 7, "chunk_no"), "idx", "v")
    chunk_sink.export_files(rows.where("id >= 100"), f"file://{tmp_path}/o", "b", F.format_string("m_results_%03d.csv", "chunk_no"), "idx", "chunk_no", "v")
    calls, fields = [], open_files.fields
    monkeypatch.setattr(open_files, "fields", lambda *a, **k: calls.append(a) or fields(*a, **k))
    monkeypatch.setattr(open_files, "TOGETHER", 3)
    got = open_files.read_open(spark, f"file://{tmp_path}/o").collect()
    assert len(calls) == 1 and len(got) == 200
    assert {(r["_path"].rpartition("_")[2], r["_idx"], r.chunk_no, r.v) for r in got} == {(f"{i:03d}.csv", 0, str(i) if i >= 100 else "", f"é,{i}") for i in range(200)}


# changed inputs, attempts, stale results


def test_what_is_pending_is_found_without_a_broadcast(spark):
    left = incremental.pending(spark.range(100), spark.range(50), "id")
    assert left.count() == 50 and "Broadcast" not in left._jdf.queryExecution().executedPlan().toString()


def test_rounds_are_over_what_is_left(spark, tmp_path):
    target, given = f"file://{tmp_path}/t", []
    spark.range(3).write.parquet(target)

    def run(p):
        given.append((p.count(), len(p.inputFiles()) > 0))
        return p.where("id % 2 = 0 or id < 10").withColumn("id", F.col("id"))

    left, turns = incremental.until_complete(spark.range(30), "id", run, target)
    # What a round is given is written, and not found anew from the whole table each time.
    assert given == [(27, True), (10, True)] and turns == 2 and left.count() == 10
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == sorted({*range(10), *range(10, 30, 2)})


def _load(spark, tmp_path, read=None):
    return incremental.ingest_files(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out", read or incremental.csv_rows(["a", "b"]))


def _rows(spark, tmp_path):
    return sorted((r.a, r.b) for r in incremental.ingested(spark, f"file://{tmp_path}/out").collect())


def test_changed_files_replace_their_rows(spark, tmp_path, monkeypatch):
    (tmp_path / "in/deep").mkdir(parents=True)
    (tmp_path / "in/x.csv").write_text("a,b\n1,2\n3,4\n")
    (tmp_path / "in/deep/y.csv").write_text("sep=;\nb;c;a\n6;0;5\n")
    assert _load(spark, tmp_path) == {"NEW": 2, "CHANGED": 0, "GONE": 0, "SAME": 0}
    assert _rows(spark, tmp_path) == [("1", "2"), ("3", "4"), ("5", "6")]
    assert _load(spark, tmp_path)["SAME"] == 2
    (tmp_path / "in/x.csv").write_text("a,b\n1,9\n")
    (tmp_path / "in/z.csv").write_text("b\n7\n")
    (tmp_path / "in/deep/y.csv").unlink()

    def broken(*_, **__):
        raise RuntimeError("ended before the list of files was published")

    with monkeypatch.context() as m:
        m.setattr(incremental, "publish", broken)
        with pytest.raises(RuntimeError):
            _load(spark, tmp_path)
    assert _rows(spark, tmp_path) == [("1", "2"), ("3", "4"), ("5", "6")]
    assert _load(spark, tmp_path) == {"NEW": 1, "CHANGED": 1, "GONE": 1, "SAME": 0}
    assert _rows(spark, tmp_path) == [("", "7"), ("1", "9")]
    os.utime(tmp_path / "in/z.csv", (1, 1))  # another time, the same length
    assert _load(spark, tmp_path)["CHANGED"] == 1 and _rows(spark, tmp_path) == [("", "7"), ("1", "9")]


def test_changed_archives(spark, tmp_path):
    import zipfile

    layout = Layout("each", ",", "S", "I")
    read = lambda paths: archives_of(paths, layout)
    (tmp_path / "in").mkdir()
    for turn, names in enumerate((("a", "b"), ("b",))):
        for n in names:
            with zipfile.ZipFile(tmp_path / f"in/{n}.zip", "w") as z:
                z.writestr("m.csv", "S,I\n" + "C,1\n" * (turn + 1))
                z.writestr("n.csv", f"I,S\n{turn},N\n")
        incremental.ingest_files(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out", read, r"\.zip$")
    got = incremental.ingested(spark, f"file://{tmp_path}/out").collect()
    assert sorted((r.path[-5], r.smiles, r.collection_id, r.member, r.row) for r in got) == [("a", "C", "1", 0, 0), ("a", "N", "0", 1, 0), ("b", "C", "1", 0, 0), ("b", "C", "1", 0, 1), ("b", "N", "1", 1, 0)]


def test_a_stream_ended_between_write_and_commit(spark, tmp_path, monkeypatch):
    src, out, ck = (f"file://{tmp_path}/{x}" for x in ("src", "out", "ck"))
    whole = incremental.write_batch

    def broken(batch, number, target):
        whole(batch, number, target)
        raise RuntimeError("ended before the batch was recorded")

    spark.range(7).write.parquet(src)
    with monkeypatch.context() as m:
        m.setattr(incremental, "write_batch", broken)
        with pytest.raises(Exception, match="ended before"):
            incremental.ingest(spark, src, "id long", out, ck, lambda s: s).awaitTermination()
    assert spark.read.parquet(out).count() == 7
    spark.range(7, 9).write.mode("append").parquet(src)
    incremental.ingest(spark, src, "id long", out, ck, lambda s: s).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(9))


def test_progress_of_a_stream_and_of_a_query(spark, tmp_path):
    from pyspark.sql import Observation

    src, told = f"file://{tmp_path}/src", []
    for n in (3, 40, 7, 5):
        spark.range(n).select(F.when(F.col("id") % 4 == 0, "A").when(F.col("id") % 4 == 1, "B").when(F.col("id") % 4 == 2, "C").alias("lib")).coalesce(1).write.mode("append").parquet(src)
    listener = progress.Progress(lambda name, n: told.append((name, n)), every=5)
    spark.streams.addListener(listener)
    try:
        incremental.ingest(spark, src, "lib string", f"file://{tmp_path}/out", f"file://{tmp_path}/ck", lambda s: progress.observed(s, "lib", ["A", "B"]), at_once=1).awaitTermination()
        for _ in range(100):
            if sum(listener.counts.values()) == 55 and told and dict(told).keys() == {"A", "B", ""} and told[-1][1] == listener.counts[told[-1][0]]:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.counts == {"A": 15, "B": 14, "": 26} and spark.read.parquet(f"{tmp_path}/out").count() == 55
    assert dict(told) == listener.counts and len(told) >= 3  # the last report of each is what it has
    seen = Observation()
    progress.observed(spark.read.parquet(src), "lib", ["A", "B"], seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"A": 15, "B": 14, "": 26}


def test_attempts_end_done_or_quarantined(spark, tmp_path):
    target, rows, seen = f"file://{tmp_path}/t", spark.range(6).withColumnRenamed("id", "k"), []

    def run(due):
        seen.append(sorted(r.k for r in due.collect()))
        bad = (F.col("k") == 3) | ((F.col("k") == 4) & F.lit(len(seen) == 1))
        return due.select("k", (~bad).alias("ok"), F.when(bad, F.lit(f"why {len(seen)}")).otherwise("").alias("details"), (F.col("k") * 2).alias("v"))

    while incremental.attempt(rows, "k", run, target):
        pass
    assert seen == [[0, 1, 2, 3, 4, 5], [3, 4], [3]]
    states = incremental.attempt_states(rows.union(spark.range(9, 10)), "k", spark.read.parquet(target))
    got = {r.k: (r.tries, r.state, r.details) for r in states.collect()}
    assert got[3] == (3, "QUARANTINED", "why 3") and got[4] == (1, "DONE", "why 1") and got[0] == (0, "DONE", "") and got[9] == (0, "DUE", "")
    waiting = incremental.attempt_states(rows, "k", spark.read.parquet(target), most=4, wait=1000.0)
    assert {r.k: r.state for r in waiting.collect()}[3] == "WAITING"


def test_stale_results_are_told(spark):
    schema = "c int, a string, b string"
    then = spark.createDataFrame([(0, "x", "y"), (0, "z", None), (1, "p", None), (2, "q", "r"), (2, "q", "r"), (3, "s", "t")], schema)
    now = spark.createDataFrame([(0, "z", None), (0, "x", "y"), (1, None, "p"), (2, "q", "r"), (4, "u", "v")], schema).repartition(3)
    kept = reconcile.fingerprint(then, ["a", "b"], "c")
    got = {r.c: r.status for r in reconcile.validity(reconcile.fingerprint(now, ["a", "b"], "c"), kept, "c").collect()}
    assert got == {0: "VALID", 1: "STALE", 2: "STALE", 3: "ORPHANED", 4: "MISSING"}


def test_verdict_and_vector_counts(spark):
    rows = spark.createDataFrame([("a", [1.0, 2.0]), ("a", None), ("b", [1.0])], "g string, v array<double>")
    assert {r.g: (r.n, r.dim, r.wrong) for r in reconcile.vector_counts(rows, "g", "v", 2).collect()} == {"a": (2, 2, 1), "b": (1, 1, 1)}
    assert tuple(reconcile.verdict(rows, F.col("v").isNotNull()).first()) == (3, 2, True)
    assert tuple(reconcile.verdict(rows, F.col("g").isNotNull()).first()) == (3, 3, False)
    assert tuple(reconcile.verdict(rows.limit(0), F.col("g").isNotNull()).first()) == (0, 0, False)


def test_results_are_kept_up_to_date(spark, tmp_path, monkeypatch):
    target, model = f"file://{tmp_path}/t", _make_model()
    schema = "chunk_no int, idx int, v string"
    first = [(c, i, f"v{c}{i}") for c in range(4) for i in range(5)] + [(4, 0, "bad"), (4, 1, "ok")]
    up = lambda rows: runs.bring_up_to_date(spark.createDataFrame(rows, schema).repartition(3), target, "v", model, ["n"])
    got = lambda: sorted((r.chunk_no, r.idx, r.v, r.n, r.status) for r in runs.results(spark, target).collect())
    want = lambda rows: sorted((c, i, v, "" if v == "bad" else str(len(v)), "FAIL" if v == "bad" else "OK") for c, i, v in rows)
    assert up(first) == {"VALID": 0, "STALE": 0, "MISSING": 5, "ORPHANED": 0} and got() == want(first)
    assert up(first[::-1]) == {"VALID": 5, "STALE": 0, "MISSING": 0, "ORPHANED": 0}
    second = [(c, i, v + "!" if (c, i) == (1, 3) else v) for c, i, v in first if c != 2] + [(9, 0, "new")]
    second = [(c, {0: 1, 1: 0}.get(i, i) if c == 3 else i, v) for c, i, v in second]  # rows changed places
    with monkeypatch.context() as m:
        m.setattr(runs, "publish", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("ended")))
        with pytest.raises(RuntimeError):
            up(second)
    assert got() == want(first)
    states = {r.chunk_no: r.status for r in runs.due(spark.createDataFrame(second, schema), target, "v").collect()}
    assert states == {0: "VALID", 1: "STALE", 2: "ORPHANED", 3: "STALE", 4: "VALID", 9: "MISSING"}
    assert up(second) == {"VALID": 2, "STALE": 2, "MISSING": 1, "ORPHANED": 1} and got() == want(second)
