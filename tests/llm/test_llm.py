import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import rows_of
from pyspark.sql import functions as F

from chunklake.llm import hnsw, license_scan, line_dedup, lz_fingerprint, mixing, packing, pii, registry, simhash_dedup, substring_dedup, toxicity
from chunklake.llm.common import materialize

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, _x string, _row string, lines int, whole string"


def table(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source); with columns whose names may clash."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 1, "x", "own", 7, "w") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd():
    """Nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6)))
    long = " ".join(word() for _ in range(30_000))
    base = "\n".join(" ".join(word() for _ in range(12)) for _ in range(12))
    near = base.replace(base.split()[7], "zzz", 1)
    shared = " ".join(word() for _ in range(120))
    rows = [(None, None), (None, ""), (1, None), (2, ""), (3, " \n\n "), (4, base), (5, base), (5, base), (6, near), (7, long), (8, long[:9000]), (9, "ünïçode ßtraße " * 40)]
    rows += [(10 + i, word() + " " + shared + " " + word() + "\n" + base.split("\n")[0]) for i in range(4)]
    return rows + [(30, "same line of five words\n" * 9), (31, "x"), (32, "a b c d e")]


ODD = odd()


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, ODD).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", registry.ORACLE_SQL)
def test_sql(spark, sf_dir, oracle, name):
    assert rows_of(registry.QUERIES[name](spark, sf_dir).toPandas()) == rows_of(oracle(registry.ORACLE_SQL[name]))


# 1


def _vectors(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v] if v is not None else None, 0) for i, v in vectors], "vec_id long, embedding array<float>, rank int")


def test_hnsw_recall(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(3000, 24)).astype(np.float32)
    data[100:160] = data[100]  # a hot vector
    df = _vectors(spark, enumerate(data.tolist()))
    got = hnsw.nearest(df.where("vec_id % 20 = 0"), df, shard=800).toPandas()
    hit = 0
    for q, g in got.groupby("query_id"):
        d = np.sqrt(((data.astype(float) - data[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(d)), d))[:10]
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 11)) and q not in set(g.vec_id)
        assert np.allclose(g.score, d[g.vec_id.to_numpy()], rtol=1e-12, atol=1e-12)
        hit += len(set(best) & set(g.vec_id))
    assert hit / (10 * got.query_id.nunique()) >= 0.9


def test_hnsw_odd_rows(spark):
    nan = float("nan")
    df = _vectors(spark, [(0, [1, 0]), (100, [0, 1]), (1, None), (2, [0, 0]), (3, [nan, 1]), (4, [2, 0]), (None, [1, 1]), (5, [1, 0]), (6, [float("inf"), 0]), (200, [3]), (7, [])])
    got = hnsw.nearest(df.where("vec_id % 100 = 0"), df).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, 5), (0, 4), (0, 100), (100, 0), (100, 5), (100, 4)]
    assert hnsw.nearest(df.where("false"), df.where("false")).count() == 0


def test_hnsw_rows_of_the_querys_own_id_hide_no_others(spark):
    df = _vectors(spark, [(0, [1, 1])] * 30 + [(5, [1, 1])] * 12 + [(i, [1, 1]) for i in range(100, 104)] + [(7, [2, 1])])
    got = hnsw.nearest(df.where("vec_id in (0, 5)").dropDuplicates(["vec_id"]), df, k=10, shard=1000).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in got] == [5] * 10 + [0] * 10
    few = hnsw.nearest(df.where("vec_id = 0").limit(1), df.where("vec_id <> 5"), k=10, shard=1000).orderBy("rank").collect()
    assert [r.vec_id for r in few] == [100, 101, 102, 103, 7]


def test_hnsw_scores_doubles_as_they_are(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "QUERIES_TOGETHER", 7)
    monkeypatch.setattr(hnsw, "QUERIES_A_COPY", 20)
    rng = np.random.default_rng(6)
    data = 1 + rng.normal(size=(300, 6)) * 1e-9  # alike as floats
    data[200:] *= 1e18
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data.tolist())], "vec_id long, embedding array<double>")
    got = hnsw.nearest(df.where("vec_id % 3 = 0"), df, shard=120).toPandas()
    assert got.query_id.nunique() == 100
    for q, g in got.groupby("query_id"):
        d = np.sqrt(((data - data[q]) ** 2).sum(1))
        assert np.allclose(g.score, d[g.vec_id.to_numpy()], rtol=1e-12, atol=0) and len(g) == 10


# 2


def test_lines(spark, docs, empty):
    unique = [(i, t) for i, (_, t) in enumerate(ODD)]
    got = {r.doc_id: r for r in line_dedup.dedup(table(spark, unique)).collect()}
    want = _whole_runs([t for _, t in unique])
    assert [got[i].text if t is not None else "" for i, t in unique] == want
    assert got[2].text is None and (got[2]["rank"], got[2]["_x"], got[2]["_row"], got[2]["lines"], got[2]["whole"]) == (1, "x", "own", 7, "w")
    assert line_dedup.dedup(docs).count() == len(ODD)
    assert line_dedup.dedup(empty).count() == 0 and line_dedup.report(empty).count() == 0


@pytest.mark.parametrize("n", [3, 100])
def test_long_line_runs(spark, n):
    """Runs whose lines have a word each, in texts of thousands of lines."""
    run = [f"r{i}" for i in range(n)]
    rows = [(i, "\n".join([f"a{i}_{k}" for k in range(2000)] + run + [f"b{i}_{k}" for k in range(500)] + (run[1:] if i == 2 else []))) for i in range(4)]
    got = {r.doc_id: (r.n_removed, r.n_runs) for r in line_dedup.dedup(table(spark, rows)).collect()}
    assert got == {0: (0, 0), 1: (n, 1), 2: (n + (n - 1), 2), 3: (n, 1)} if n > 5 else got[3] == ((n, 1) if n >= 5 else (0, 0))
    found = {(r.doc_id, r.line, r.n_lines, r.copies) for r in line_dedup.report(table(spark, rows)).collect()}
    assert found == ({(0, 2000, n, 3)} | ({(0, 2001, n - 1, 1)} if n > 5 else set()) if n >= 5 else set())


def test_deeper_line_runs(spark):
    run = [f"l{i} a b" for i in range(6)]
    got = line_dedup.dedup(table(spark, [(1, "\n".join(run)), (2, "\n".join(["x", *run[1:5], "y", *run[:3]]))]), min_lines=4, min_words=9).orderBy("doc_id").collect()
    assert got[0].n_removed == 0 and got[1].text.split("\n") == ["x", "y", *run[:3]]


def _whole_runs(rows, min_words=5):
    """The texts without later copies of whole runs, by brute force."""
    docs, seen, out = [(t or "").split("\n") for t in rows], {}, []
    for r, lines in enumerate(docs):
        gone = set()
        for a, x in enumerate(lines):
            longest = 0
            for q, b in seen.get(x, ()):
                n = 0
                while a + n < len(lines) and b + n < len(docs[q]) and lines[a + n] == docs[q][b + n]:
                    n += 1
                longest = max(longest, n)
            seen.setdefault(x, []).append((r, a))
            if longest and sum(len(re.findall(r"[^\x20\x09-\x0D]+", y)) for y in lines[a : a + longest]) >= min_words:
                gone |= set(range(a, a + longest))
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def test_whole_line_runs(spark, docs, empty):
    rng = random.Random(12)
    texts_ = ["a b e\n\nc\n\n\nd\nx", "y\na b e\n\nc\n\n\nd\nz", "a b e\n\nc", "five words are in here\n\n\n\nq", "r\nfive words are in here\n\n\n\nq", "\n" * 40 + "w", "k k\n" * 9]
    texts_ += ["\n".join(rng.choice(["", "a", "b", "a b", "c d e", "f g h i j k"]) for _ in range(rng.randint(1, 14))) for _ in range(60)]
    texts_ += [t for _, t in ODD]
    got = {r.doc_id: r.text for r in line_dedup.dedup(table(spark, list(enumerate(texts_)))).collect()}
    want = _whole_runs(texts_)
    assert want[1] == "y\nz" and want[2] == "a b e\n\nc" and want[4] == "r"
    assert [got[i] or "" for i in range(len(texts_))] == want
    assert line_dedup.dedup(docs).count() == len(ODD) and line_dedup.dedup(empty).count() == 0


# 3


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    plain = Tokenizer.from_file(path)
    got = packing.pack(docs, size=512).toPandas()
    want = {}
    for doc, text in ODD:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 512):
            piece = np.array(ids[at : at + 512], "<u4").tobytes()
            key = (doc if doc is not None else -1, at, len(piece) // 4, zlib.crc32(piece), len(ids))
            want[key] = want.get(key, 0) + 1
    keys = list(zip(got.doc_id.fillna(-1).astype(int), got.start, got.length, got.ids_crc32, got.doc_tokens, strict=True))
    assert {k: keys.count(k) for k in set(keys)} == want
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 512
    assert packing.pack(empty).count() == 0


def test_words_are_tokenised_as_the_tokenizer_does():
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    plain = Tokenizer.from_file(path)
    texts_ = ["It's I'LL x'sy don't", "Straße ÀÉ é ﬁ Ǆ İI ΑΣ ς", "12½² a1b2 --..!? <|endoftext|> a<|startoftext|>b", "日本語 текст  x y\x1cz\x85q", "", " \n", "🙂🙂a🙂", "à́b ʼnŉ"]
    texts_ += ["".join(chr(c) for c in range(a, a + 64)) for a in range(32, 0x300, 64)]
    assert packing.encode(texts_, path) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts_]


def test_new_words_are_tokenised_in_one_call(monkeypatch):
    """Not one by one, which took most of packing's time; repeated ones are remembered, odd ones keep their place."""
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    plain = Tokenizer.from_file(path)
    monkeypatch.setattr(packing, "_encoders", {})
    monkeypatch.setattr(packing, "_known", {})
    packing.encode([""], path)
    encoder, calls = packing._encoders[path], []
    merge = encoder.merge
    monkeypatch.setattr(encoder, "merge", lambda text, *a, **b: calls.append(text) or merge(text, *a, **b))
    blanks = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts_ = [f" qz{i}x, twice{i} twice{i} " + "日 <|endoftext|>z a\x00b" * (i % 3 == 0) for i in range(3000)]
    texts_ += [f"a{b}b{b}{b}É {b}c,{b}" for b in blanks] + ["", "\n", *(b * 3 for b in blanks)]
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch_fast(texts_, add_special_tokens=False)]
    assert packing.encode(texts_, path) == want and len(calls) == 1
    assert packing.encode([f"twice{i}" for i in range(3000)], path) == [np.array(plain.encode(f"twice{i}").ids, "<u4").tobytes() for i in range(3000)]
    assert len(calls) == 1


def test_texts_are_tokenised_together_in_bounds(monkeypatch):
    """Rows of many small batches, or of a large one, in order; one text above the bound comes alone."""
    monkeypatch.setattr(packing, "TOGETHER", 1000)
    text = ["x" * n for n in [0, 10, 300, 500, 5000, 0, 900, 20, *[7] * 100]]
    whole = pa.RecordBatch.from_arrays([pa.array(range(len(text))), pa.array(text)], ["doc_id", "text"])
    for batches in ([whole], [whole[i : i + 1] for i in range(len(text))], [whole[:0], whole[:50], whole[50:], whole[:0]]):
        got = [t.to_pydict() for t in packing._together(iter(batches))]
        assert [x for g in got for x in g["text"]] == text and [x for g in got for x in g["doc_id"]] == list(range(len(text)))
        assert all(len(g["text"]) == 1 or sum(len(x) + packing.ROW for x in g["text"]) <= 1000 for g in got) and 10 < len(got) < 16
    assert not list(packing._together(iter([]))) and not list(packing._together(iter([whole[:0]])))


def test_patterns_hold_the_histogram():
    rng = random.Random(1)
    hist = {rng.randint(1, 2048): rng.randint(1, 9) for _ in range(300)}
    found = packing.patterns(hist)
    held = {}
    for count, lengths in found:
        assert sum(lengths) <= 2048
        for x in lengths:
            held[x] = held.get(x, 0) + count
    assert held == hist


# 4


def test_mixing(spark, docs, empty):
    rows = [(i, "w " * (i % 40), f"s{i % 7 if i % 3 else 0}" if i % 50 else None) for i in range(900)]
    got = mixing.mix(table(spark, rows)).toPandas()
    again = mixing.mix(table(spark, rows[::-1])).toPandas()
    assert sorted(zip(got.doc_id, got.copies, strict=True)) == sorted(zip(again.doc_id, again.copies, strict=True))
    assert got.copies.max() <= 3
    total = got["size"].sum()
    sources = got.groupby(got.source.fillna("~")).agg(size=("source_size", "first"), target=("target", "first"))
    assert abs(sources.target.sum() - total) < 1e-6 * total and (sources.target <= 3 * sources["size"] + 1e-9).all()
    weight = np.array([1, 2, 3] * 9)[: len(sources)]
    level = (sources.target / weight).max()
    assert np.allclose(sources.target, np.minimum(3 * sources["size"], level * weight))
    taken = (got.copies * got["size"]).groupby(got.source.fillna("~")).sum()
    assert ((taken - sources.target).abs() <= 2 * 40).all()
    assert mixing.mix(docs).count() == len(ODD)
    assert mixing.mix(empty).count() == 0


# 5

EXPRESSIONS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def _base(text):
    out = []
    for kind, e in enumerate(EXPRESSIONS):
        for m in re.finditer(e, text):
            digits = re.sub("[^0-9]", "", m.group())
            double = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits)))
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")) or kind == 2 and not (13 <= len(digits) <= 19 and double % 10 == 0) or kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans():
    rng = random.Random(8)
    texts_ = ["".join(rng.choices("a1@.+-% (9", k=60)) for _ in range(3000)]
    texts_ += ["a@b.c%d@e.f.g@h.i", "1.2.3.4.5.6.7.8", "4111 1111-1111 1111 x", "é a.b@c-d.e. +1 (555) 010-9999.", "@@a@b", "0001.002.3.255", "1" * 5000]
    for t in texts_:
        assert pii.base_spans(t) == _base(t)


def test_pii(spark, docs, empty):
    seeds = [(i, f"please mail user{i}@mail.example.com today {i}") for i in range(12)]
    hidden = [(20 + i, f"please mail user{i}#mail0 today") for i in range(3)]
    # Tokens of other kinds, beside which the seeds are not there by accident.
    other = [(50 + i, f"number {i} of {i + 1000} or {i + 7777}x") for i in range(100)]
    got = {r.doc_id: r for r in pii.extract(table(spark, seeds + hidden + other)).collect()}
    assert not any(got[50 + i].found for i in range(100))
    assert all(got[i].n_email == 1 for i in range(12))
    assert [[(s.kind, hidden[i][1][s.start : s.end]) for s in got[20 + i].found] for i in range(3)] == [[(0, f"user{i}#mail0")] for i in range(3)]
    assert got[20].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.extract(docs).count() == len(ODD) and pii.extract(empty).count() == 0


def _bootstrapped(texts_, rounds, confident, seeds):
    """The spans that patterns add, by the definition: (text, kind, start, end)."""
    noted = [(n, t["kind"], t["start"], t["end"], t["surface"], p) for n, text in enumerate(texts_) for t in pii.tokens(text, _base(text)) for p in t["patterns"]]
    count, known = {}, {(s, k): 1.0 for _, k, _, _, s, _ in noted if k is not None}
    for _, _, _, _, s, p in noted:
        count[p, s] = count.get((p, s), 0) + 1
    x, edges = dict(known), {}
    for (p, s), n in count.items():
        edges.setdefault(p, {})[s] = n
    tried, surfaces = sum(len(of) >= seeds for of in edges.values()), len({s for _, s in count})
    rate = [sum(q == k for _, q in known) / surfaces for k in range(5)]
    for turn in range(rounds):
        held = {}
        for p, of in edges.items():
            for k in range(5):
                hits, got = sum(n * x.get((s, k), 0) for s, n in of.items()), sum(x.get((s, k), 0) >= confident for s in of)
                q = got / len(of)
                if got >= seeds and q > rate[k]:
                    bound = (q / rate[k]) ** -got * (1 if q == 1 else ((1 - q) / (1 - rate[k])) ** (got - len(of)))
                    if bound <= pii.CHANCE / tried:
                        held[p, k] = hits / (sum(of.values()) + 1)
        if turn + 1 < rounds:
            x = dict(known)
            for (p, s), _ in count.items():
                for k in range(5):
                    if (p, k) in held:
                        x[s, k] = max(x.get((s, k), 0), held[p, k])
    out = {}
    for n, k, a, b, _, p in noted:
        if k in (None, 4):
            for kind in range(5):
                if held.get((p, kind), 0) >= confident:
                    out[n, a, b] = max(out.get((n, a, b), (0, -9)), (held[p, kind], -kind))
    return {(n, -k, a, b) for (n, a, b), (_, k) in out.items()}


def test_pii_discovery_is_that_of_the_definition(spark):
    """A planted table of 1,200 texts: cues of one and two words, secrets, decoys; all spans and their precision."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    texts_, right = [], set()
    for i in range(1200):
        cue, kind, value = rng.choice([("mail:", 0, f"{word()}{i}@m{i}.example.org"), ("reach me", 3, f"+44 (0{i % 90 + 10}) 5550-{i:04}"), ("token =", 4, hashlib.sha1(str(i).encode()).hexdigest()), ("order", None, f"{i}"), (word(), 5, f"password={hashlib.md5(str(i).encode()).hexdigest()[:18]}"), (word(), 4, f"AKIA{word().upper()[:3]:X<3}{i:04}ABCDEFGHI")])
        if kind == 0 and i % 4 == 0:
            value = f"{word()}{i}(at)host"
        elif kind == 3 and i % 4 == 0:
            value = f"0{i}x"
        elif cue == "token =" and i % 4 == 0:
            value = f"{word()}-{i}-" + "z" * (200 if i % 8 else 5)
        texts_.append(f"{word()} {word()} {cue} ")
        if kind == 5:
            texts_[-1], kind, value = texts_[-1] + value[:9], 4, value[9:]
        if kind is not None and (i % 4 == 0 or kind == 4):
            right.add((i, kind, len(texts_[-1]), len(texts_[-1]) + len(value)))
        texts_[-1] += f"{value} {word()} {rng.randint(0, 10**9)} {word()}"
    rows = table(spark, list(enumerate(texts_)))
    found = {(r.doc_id, s.kind, s.start, s.end) for r in pii.extract(rows).collect() for s in r.found}
    base = {(n, *s) for n, t in enumerate(texts_) for s in _base(t)}
    assert base <= found
    assert found - base == _bootstrapped(texts_, pii.ROUNDS, pii.CONFIDENT, pii.SEEDS)
    # Precision and recall are 1, but for digests in which digits pass as a card.
    assert found - base == {(n, k, a, b) for n, k, a, b in right if not any(n == m and c < b and a < d for m, _, c, d in base)} and len(found - base) > 400


# 6


def _slow_fingerprint(text):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def _components(fps, limit=3):
    label = list(range(len(fps)))
    for _ in fps:
        for i, a in enumerate(fps):
            for j, b in enumerate(fps[:i]):
                if bin(a ^ b).count("1") <= limit:
                    label[i] = label[j] = min(label[i], label[j])
    return label


def test_fingerprints(monkeypatch):
    for _, t in ODD:
        assert simhash_dedup.fingerprint(t) == _slow_fingerprint(t)
    monkeypatch.setattr(simhash_dedup, "BLOCK", 7)
    for _, t in ODD:
        assert simhash_dedup.fingerprint((t or "")[:3000]) == _slow_fingerprint((t or "")[:3000])


@pytest.mark.parametrize("crowd", [32, 2])
def test_links(spark, monkeypatch, crowd):
    """Small families, a hot one, and one of near copies 4 to 8 bits from their centre."""
    monkeypatch.setattr(simhash_dedup, "CROWD", crowd)
    rng = random.Random(2)
    fps = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(8)}
    hot = rng.getrandbits(64)
    fps |= {hot ^ sum(1 << b for b in rng.sample(range(20), rng.randint(0, 5))) for _ in range(150)}
    wide = rng.getrandbits(64)
    fps |= {wide ^ sum(1 << b for b in rng.sample(range(14), rng.randint(4, 8))) for _ in range(150)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    from chunklake.llm.graph import components

    found = components(simhash_dedup.links(spark.createDataFrame([(f, 1) for f in signed], "fp long, n long"))).collect()
    part = {r.node: r.component for r in found}
    classes, want = {}, {}
    for s, w in zip(signed, _components(fps), strict=True):
        classes.setdefault(part.get(s, s), set()).add(s)
        want.setdefault(w, set()).add(s)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, want.values()))


def test_simhash_odd_rows(spark, docs, empty):
    got = simhash_dedup.classes(docs).toPandas()
    assert len(got) == len(ODD)
    by = got.dropna().groupby("doc_id").component_id.first()
    assert by[4] == by[5] == by[6] == 4 and by[1] == by[2] == by[3] == 1
    assert simhash_dedup.classes(empty).count() == 0
    kept = simhash_dedup.dedup(docs)
    assert {4, 1} <= {r.doc_id for r in kept.collect()} and not {5, 6, 2} & {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns


def test_simhash_keeps_one_row_of_each_class(spark):
    one, two, three = ("\n".join(f"{c}{i} {c}{i * i} {i}{c}" for i in range(60)) for c in "abc")
    rows = [(1, one), (1, one), (None, two), (None, two), (2, two), (1, three), (None, "alone " * 9), (None, "alone " * 9)]
    kept = simhash_dedup.dedup(table(spark, rows).repartition(3)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(1, one), (2, two), (1, three), (0, "alone " * 9)])


def _five_words(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m.group().lower(), text or ""))
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)} or ({" ".join(words)} if words else set())


def _similar(texts_):
    """The least index of each text's class, all pairs compared by whole shingle sets."""
    sets = [_five_words(t) for t in texts_]
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) / len(a | b) >= 0.8:
                old, new = sorted((label[i], label[j]), reverse=True)
                label = [new if x == old else x for x in label]
    return label


@pytest.mark.parametrize("crowd", [32, 2])
def test_similar_classes(spark, monkeypatch, crowd):
    """Families of edited texts from under 0.5 to 1, a hot one of exact and near copies, short texts, repeats within a text."""
    monkeypatch.setattr(simhash_dedup, "CROWD", crowd)
    rng = random.Random(9)

    def words(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    rows = [None, "", " \n", "One two", "one TWO", "a b c d e", "a b c d e f", "a b c d e f g", "x y z w v " * 9, "x y z w v " * 90]
    for _ in range(25):
        base = words(rng.choice((30, 120, 400)))
        for _ in range(6):
            text = list(base)
            for at in rng.sample(range(len(text)), len(text) * rng.randint(0, 8) // 100):
                text[at] = words(1)[0]
            rows.append(" ".join(text))
    hot = words(200)
    rows += [" ".join(hot)] * 40 + [" ".join(hot[: 200 - k] + words(k)) for k in range(0, 60)] + [" ".join(hot[:130] + words(70)) for _ in range(20)]
    long = words(20_000)
    rows += [" ".join(long), " ".join(long[:-2000] + words(2000)), " ".join(long[:-9000] + words(9000))]
    want = _similar(rows)
    found = simhash_dedup.similar_classes(table(spark, list(enumerate(rows))).repartition(4)).collect()
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(want))
    assert 30 < len(set(want)) < len(rows) - 60


def test_similar_prunes_no_pair():
    """Sets of a similarity of 0.8 and more stay within the pruning filter and share a band."""
    rng = np.random.default_rng(1)
    for n in (20, 200, 2000):
        for _ in range(60):
            own = n // 10
            both = rng.integers(0, 1 << 64, n - own, np.uint64)
            one, two = (np.concatenate([both, rng.integers(0, 1 << 64, own, np.uint64)]) for _ in range(2))
            a, b = (simhash_dedup._fingerprint([x]) for x in (one, two))
            assert bin(a ^ b).count("1") <= simhash_dedup.allowance(0.8)
            (keys, bits), (others, other) = simhash_dedup.sketch(one), simhash_dedup.sketch(two)
            # Two bands: that is what pairs in crowded groups need.
            assert (keys == others).sum() >= 2
            assert bin(int.from_bytes((bits ^ other).tobytes(), "little")).count("1") <= simhash_dedup.bits_allowed(0.8)


def test_bits_of_minimum_hashes_tell_half_alike_sets():
    rng, left = np.random.default_rng(2), 0
    for _ in range(200):
        both = rng.integers(0, 1 << 64, 200, np.uint64)
        (_, a), (_, b) = (simhash_dedup.sketch(np.concatenate([both, rng.integers(0, 1 << 64, 100, np.uint64)])) for _ in range(2))
        left += bin(int.from_bytes((a ^ b).tobytes(), "little")).count("1") <= simhash_dedup.bits_allowed(0.8)
    assert left < 20  # of pairs at 0.5


def test_similar_keeps_one_row_of_each_class(spark, docs, empty):
    kept = simhash_dedup.dedup_similar(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(_similar([r.text for r in docs.collect()])))
    assert simhash_dedup.dedup_similar(empty).count() == 0


# 7


@pytest.mark.parametrize("seed", range(6))
def test_repeated_starts_are_those_of_brute_force(seed):
    """Groups of up to 300 regions with long common parts on either side of the anchor, also with every hash in collision."""
    rng = random.Random(seed)
    width, anchor = 40, b"ANCHORANCHOR"
    n = (2, 3, 9, 40, 120, 300)[seed]
    left = [bytes(rng.choice(b"ab") for _ in range(28)) for _ in range(4)]
    right = [bytes(rng.choice(b"ab") for _ in range(28)) for _ in range(4)]

    def side(choices, back):
        cut = rng.randint(0, 28)
        new = bytes(rng.choice(b"ab") for _ in range(28 - cut))
        old = rng.choice(choices)
        return new + old[28 - cut :] if back else old[:cut] + new

    group = []
    for i in range(n):
        a, b = rng.randint(0, 28), rng.randint(0, 28)
        before, after = side(left, True)[28 - a :], side(right, False)[:b]
        if a + b + len(anchor) >= width:
            data = before + anchor + after
            group.append(substring_dedup._Region(i, 0, len(data) - width, a, 1, data))
    if len(group) > 1:
        want = []
        for x in group:
            others = {(y.at - s, y.data[s : s + width]) for y in group if y is not x for s in range(y.starts)}
            want.append([(x.at - s, x.data[s : s + width]) in others for s in range(x.starts)])
        assert [m.tolist() for m in substring_dedup.repeated(group, width)] == want
        real = substring_dedup._equal
        try:  # hashes that agree now and then where bytes do not
            substring_dedup._equal = lambda x, a, y, b, k, up: real(x, a, y, b, k, up) or (a * 7 + b * 3 + k) % 5 == 0
            for x in group[:12]:
                for y in group[:12]:
                    got = substring_dedup.extension(x, y, substring_dedup._power(200)[0].tolist(), True)
                    assert x.data[x.at : x.at + got] == y.data[y.at : y.at + got]
        finally:
            substring_dedup._equal = real


@pytest.mark.parametrize("together", [8192, 1, 8])
def test_substrings(spark, together):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = text(1500)
    texts_ = ["", None, "x" * 399, "x" * 900, shared[:399], shared[:400], text(700) + shared + text(700), shared[200:1200] + text(300) + shared[900:]]
    texts_ += [text(90) + shared[:700] + text(5) + shared[705:] for _ in range(30)] + ["ab" * 600, "ab" * 450] + [text(2000)] * 3
    rows = [(i, t) for i, t in enumerate(texts_)]
    got = {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in substring_dedup.dedup(table(spark, rows), together=together).collect()}
    want = substring_dedup.brute_force([t or "" for t in texts_])
    assert [got[i] for i in range(len(rows))] == want


def _passages(frame, **how):
    return {r.doc_id: [(p.begin, p.end) for p in r.passages] for r in substring_dedup.dedup(frame, **how).collect()}


def test_passages_shorter_than_a_removed_string(spark):
    rng = random.Random(11)
    prose = lambda n: [rng.choice("abcdefgh") + str(rng.randrange(1000)) for _ in range(n)]
    passage = prose(55)
    assert len(" ".join(passage)) < 400
    rows = [(0, " ".join(prose(70) + passage + prose(30))), (1, "\n".join(passage)), (2, " ".join(passage[:49] + prose(90))), (3, " ".join(prose(60)) + " x" * 300), (4, None)]
    found = substring_dedup.dedup(table(spark, rows)).select("doc_id", F.size("spans"), F.size("passages")).where("doc_id < 3")
    assert sorted(map(tuple, found.collect())) == [(0, 0, 1), (1, 0, 1), (2, 0, 0)]
    assert _passages(table(spark, rows)) == {0: [(70, 125)], 1: [(0, 55)], 2: [], 3: [], 4: []}


@pytest.mark.parametrize("words", [1, 6, 50])
def test_passages(spark, words, monkeypatch):
    rng = random.Random(words)
    prose = lambda n: [rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(n)]
    shared, twice = prose(160), prose(60)
    parts = [[], shared, shared[:50], shared[20:69], twice + ["z"] + twice, prose(40) + shared[10:90] + prose(40), shared[:70] + ["y"] + shared[71:], ["x"] * 130, ["x"] * 51 + ["w"]]
    # Of a region that several rows have, and one of the first row's own at the same anchor.
    parts += [shared[:80] + prose(30) + shared[5:75] + prose(9), shared[:80] + prose(20), prose(200), prose(200), *([prose(60)] * 3)]
    parts += [prose(rng.randint(0, 40)) + shared[rng.randint(0, 60) :][: rng.randint(30, 90)] + prose(20) for _ in range(30)]
    texts_ = ["".join(w + rng.choice((" ", "\n", "\t ")) for w in p) for p in parts]
    got = _passages(table(spark, list(enumerate(texts_))), words=words)
    assert [got[i] for i in range(len(texts_))] == substring_dedup.brute_force_passages(texts_, words)
    whole = [substring_dedup.word_hashes(t.encode()).tolist() for t in texts_]
    monkeypatch.setattr(substring_dedup, "SLICE", 37)
    assert [substring_dedup.word_hashes(t.encode()).tolist() for t in texts_] == whole


def test_substrings_odd_rows(docs, empty):
    got = sorted((r.n_bytes, len(r.kept)) for r in substring_dedup.dedup(docs).collect())
    assert got == sorted((w[0], w[0] - w[1]) for w in substring_dedup.brute_force([t or "" for _, t in ODD]))
    assert substring_dedup.dedup(empty).count() == 0


# 8


def _arrays(counts):
    return np.array([*counts], np.int64), np.array([*counts.values()], np.int64)


def _dense(index, rows, counts):
    """Cosines with all examples, from their counts."""

    def vector(c):
        v = {f: (1 + np.log(n)) * index.factor[f] for f, n in c.items()}
        size = np.sqrt(sum(x * x for x in v.values()))
        return {f: x / size for f, x in v.items()}

    own = vector(counts)
    return {i: sum(x * w for f, w in vector(c).items() if (x := own.get(f))) if c else 0.0 for i, _, c in rows}


@pytest.mark.parametrize("common", [16, 3, 1, 10**6])
def test_block_max_search_is_exact(monkeypatch, common):
    monkeypatch.setattr(toxicity, "COMMON", common)
    rng = np.random.default_rng(1)
    chance = 1 / np.arange(1, 51)
    rows = [(i, int(rng.random() < 0.2), {int(f): int(n) for f, n in zip(rng.choice(50, 5, replace=False, p=chance / chance.sum()), rng.integers(1, 4, 5), strict=True)} if i % 9 else {}) for i in range(500)]
    index = toxicity.Index({f"f{i}": i for i in range(50)}, rng.integers(1, 400, 50).astype(float), 500, [(i, y, _arrays(c)) for i, y, c in rows], 0.2, tie=rng.random(50) ** 4 + 0.01)
    for _, _, counts in rows[:60]:
        if counts:
            all_ = _dense(index, rows, counts)
            at, sims = index.nearest(_arrays(counts))
            assert np.allclose(sims, sorted(all_.values(), reverse=True)[: len(sims)]) and len(sims) == toxicity.NEAREST
            assert np.allclose(sims, [all_[i] for i in index.ids[at]])
            got, evidence = index.score(_arrays(counts))
            assert got == pytest.approx(_vote(index, rows, counts)) and evidence == index.ids[at[:3]].tolist()
    # No other slope or shift fits the examples, each scored without itself, better.
    x = np.array([index._logit(*index.nearest(_arrays(c), skip=i)) for i, _, c in rows if c])
    y = np.array([t for _, t, c in rows if c])
    loss = lambda a, b: (index.weight[y] * np.log1p(np.exp(-(2 * y - 1) * (a * x + b)))).sum() + ((a - 1) ** 2 + b * b) / 2
    best = loss(index.slope, index.shift)
    assert index.slope == 1 or all(best <= loss(index.slope + da, index.shift + db) for da in (-0.01, 0, 0.01) for db in (-0.01, 0, 0.01))


def test_ties_grow_with_evidence():
    p, q = np.array([0.0, 1, 5, 30, 30, 0, 3]), np.array([0.0, 0, 0, 30, 0, 30, 3])
    got = toxicity.ties(p, q, 40, 60)
    assert (got >= toxicity.LEAST).all() and got[0] < 0.02 and got[1] < 0.05 < got[2] < got[4]
    assert got[4] > 10 and got[5] > 3 and got[3] < 0.5 and got[6] < 0.02  # half the others hold the fourth, too
    a, b, z = np.log(30.5 / 10.5) - np.log(0.5 / 60.5), 1 / 30.5 + 1 / 10.5 + 2 + 1 / 60.5, toxicity.HALF**4
    assert got[4] == pytest.approx(toxicity.LEAST + a * a * (a * a / b) ** 2 / ((a * a / b) ** 2 + z))
    assert len(toxicity.ties(np.zeros(0), np.zeros(0), 0, 0)) == 0


def test_counts_are_those_of_features():
    rng = random.Random(2)
    texts_ = [" ".join("".join(rng.choice("abAé") for _ in range(rng.randint(1, 3))) for _ in range(200)) for _ in range(20)]
    every = sorted({f for t in texts_[:10] for f in toxicity.features(t)})
    vocabulary = {f: i for i, f in enumerate(rng.sample(every, 30))}
    count = toxicity.counter(vocabulary)
    for t in texts_:
        assert dict(zip(*(x.tolist() for x in count(t)), strict=True)) == {vocabulary[f]: n for f, n in toxicity.features(t).items() if f in vocabulary}


def test_very_long_texts_are_scored_whole(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("klmnop") for _ in range(4))
    rows = [(i, " ".join([word() for _ in range(30)] + ["scumbag"] * 2 * (i % 2))) for i in range(200)]
    long = " ".join(word() for _ in range(60_000))
    rows += [(1000, long), (1001, long + " scumbag" * 9000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(1001, 1)], "doc_id long, toxic int")
    index = toxicity.fit(table(spark, rows), labels)
    got = {r.doc_id: r.score for r in toxicity.score(table(spark, rows), index).collect()}
    assert len(index.ids) == 200  # the long one is no example
    assert got[1001] > got[1000] and got[1001] == pytest.approx(index.score(toxicity.counter(index.vocabulary)(rows[-1][1]))[0])


def test_toxicity(spark, docs, empty):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("klmnop") for _ in range(4))
    rows = [(i, " ".join([word() for _ in range(30)] + (["scumbag"] * 2 if i % 5 == 0 else []))) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)] + [(None, 1), (7, None), (3, 0)], "doc_id long, toxic int")
    index = toxicity.fit(table(spark, rows), labels)
    assert index.idf.tolist() == pytest.approx([np.log(401 / (1 + sum(f in toxicity.features(t) for _, t in rows))) + 1e-3 for f in index.vocabulary])
    got = {r.doc_id: r for r in toxicity.score(table(spark, rows), index).collect()}
    count = toxicity.counter(index.vocabulary)
    assert all(got[i].score == pytest.approx(index.score(count(t))[0]) for i, t in rows)
    assert all((got[i].score >= toxicity.THRESHOLD) == (i % 5 == 0) for i in range(300, 400))
    assert got[305].evidence and all(e % 5 == 0 for e in got[305].evidence)
    assert toxicity.score(docs, index).where("score >= 0 and score <= 1").count() == len(ODD)
    # A repeated id gives an example for each row, and no more than the bound.
    twice = toxicity.fit(table(spark, rows + rows[:50]), labels, examples=100)
    assert sum(y for _, y, _ in toxicity.learn(toxicity.keyed_rows(table(spark, rows + rows[:50])), labels, 100).rows) == 50 and len(twice.ids) == 100
    nothing = toxicity.fit(empty, labels.where("false"))
    assert toxicity.score(empty, nothing).count() == 0 and toxicity.score(docs, nothing).count() == len(ODD)


def test_held_out_rows_are_those_of_crc32(spark):
    got = spark.range(200).withColumnRenamed("id", "doc_id").select("doc_id", toxicity.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


# 9


def test_licenses(spark, docs, empty):
    notice = license_scan.TEMPLATES["mit-notice"][0]
    cut = notice.split()
    cut[10] = "changed"
    pad = " filler words here" * 30
    rows = [(1, pad + " Released under the MIT License. " + pad), (2, pad + " ".join(cut) + pad), (3, " ".join(notice.split()[: len(notice.split()) // 2])), (4, "licensed  UNDER cc-by nc 4.0"), (5, None)]
    rows += [(6 + i, " x" * i + "\n" + notice + pad) for i in range(20)]
    got = {}
    for r in license_scan.scan(table(spark, rows)).collect():
        got.setdefault(r.doc_id, {})[r.license] = r.containment
    assert got.pop(1) == {"mit": 1.0} and got.pop(4) == {"cc-by-nc-4.0": 1.0}
    assert 0.9 < got.pop(2)["mit-notice"] < 1 and 3 not in got
    assert got == {6 + i: {"mit-notice": 1.0} for i in range(20)}
    assert license_scan.scan(docs).count() == 0 and license_scan.scan(empty).count() == 0
    assert license_scan.scan(docs, {}).count() == 0
    with pytest.raises(ValueError, match="fewer than 5 words"):
        license_scan.scan(docs, {"short": ("three words only",)})


def test_licenses_against_all_windows(spark):
    """Every template with none to a fifth of its words changed, in one very long text and in many: found where
    a window of a template's length holds 0.8 of its shingles, by brute force.  Recall here: all that are 0.8 and more."""
    rng = random.Random(5)
    words = lambda t: [w for w in re.split(r"[^0-9a-z]+", t.lower()) if w]
    texts_, parts = [], []
    for ts in license_scan.TEMPLATES.values():
        for t in ts:
            for share in (0, 0.02, 0.05, 0.2):
                parts.append(" ".join("".join(rng.choices("xyz", k=5)) if rng.random() < share else w for w in words(t)))
                texts_.append(f"some words before {parts[-1]} and after it")
    texts_.append(" filler text of words ".join(parts * 3))
    grams = lambda ws: [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    known = [(n, set(grams(words(t)))) for n, ts in license_scan.TEMPLATES.items() for t in ts]
    want, near = set(), set()
    for d, text in enumerate(texts_):
        g = grams(words(text))
        for name, shingles in known:
            n = len(shingles)
            step = max(1, n // 8)
            for w, out in ((n, want), (n if step == 1 else n + 2 * step, near)):
                if any(len(shingles.intersection(g[i : i + w])) >= 0.8 * n for i in range(max(1, len(g) - w + 1))):
                    out.add((d, name))
    rows = table(spark, list(enumerate(texts_)))
    got = {(r.doc_id, r.license): r for r in license_scan.scan(rows).collect()}
    assert want <= got.keys() <= near and len(want) > 80


# 10


def test_lz(spark, docs, empty):
    rows = [(i * 3, t) for i, (_, t) in enumerate(ODD)]
    got = {r.doc_id: r for r in lz_fingerprint.compare(table(spark, rows).repartition(3)).collect()}
    for k, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text) // 4
        new = text[: len(text) - n] + following[:n]
        r, own, then = got[doc], lz_fingerprint.fingerprint(text), lz_fingerprint.fingerprint(following)
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), hashlib.sha256(new.encode()).hexdigest(), own, lz_fingerprint.fingerprint(new))
        assert r.near_next == lz_fingerprint.likeness(bytes.fromhex(own), bytes.fromhex(then)) and 0 <= r.near_edited <= 1
    assert lz_fingerprint.compare(docs).count() == len(ODD) and lz_fingerprint.compare(empty).count() == 0
    one = lz_fingerprint.compare(table(spark, [(1, "a b c d e f g h")])).first()
    assert one.near_next == 1.0


def test_lz_phrases_and_signature_by_definition():
    """LZ78 over tuples of units, each known phrase a tuple; the least hash of each of 128 ranges by trying all."""
    rng = random.Random(8)
    odd_texts = ["", " ", "a", "a a a a a a a", "\n\n a\u2003b", "x" * 40, " ".join(rng.choice("abc") for _ in range(400)), " ".join(rng.choice(["ü", "longer-than-sixteen-letters", "c\t"]) for _ in range(90)), *(t for _, t in ODD if t)]
    for text in odd_texts:
        known, at = set(), ()
        for unit in re.findall(r"\s*\S{1,16}|\s+", text):
            at = (*at, unit)
            if at not in known:
                known.add(at)
                at = ()
        hashes = set()
        for phrase in known:
            h = 0
            for unit in phrase:
                h = xxhash.xxh64_intdigest(unit, h)
            hashes.add(h)
        assert lz_fingerprint.phrases(text) == hashes and len(hashes) == len(known)
        want = []
        for k in range(128):
            for away in range(128 if hashes else 0):
                if held := [h for h in hashes if h // 2**57 == (k + away) % 128]:
                    want.append((min(held) % 256 + 37 * away) % 256)
                    break
        assert lz_fingerprint.signature(hashes) == bytes(want or 128)


def test_lz_of_very_long_texts(spark):
    rng = random.Random(5)
    long = " ".join(str(rng.randint(0, 10**6)) for _ in range(300_000))
    rows = [(1, long), (2, long[:1_500_000] + long[:100] * 3), (3, "short")]
    got = {r.doc_id: r for r in lz_fingerprint.compare(table(spark, rows)).collect()}
    assert got[1].fingerprint == lz_fingerprint.fingerprint(long) and got[1].n_chars == len(long)
    assert got[1].near_next > 0.5 > got[2].near_next


def test_lz_with_many_equal_and_missing_ids(spark):
    """Each text has one next text, and they go round."""
    rng = random.Random(9)
    texts_ = [" ".join(str(rng.randint(0, 99)) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    rows = [(None if i % 3 else 7, t) for i, t in enumerate(texts_)] + [(7, "same " * 20)] * 100
    got = lz_fingerprint.compare(table(spark, rows).repartition(5)).collect()
    assert len(got) == len(rows) and sum(r.doc_id == 7 for r in got) == 200
    from collections import Counter

    heads = lambda n: {t[:n] for _, t in rows}
    sizes = Counter(len(t) for _, t in rows)
    assert Counter(r.n_chars for r in got) == sizes
    edits = {hashlib.sha256((t[: len(t) - len(t) // 4] + h).encode()).hexdigest() for _, t in rows for h in heads(len(t) // 4)}
    assert all(r.edited_sha256 in edits for r in got)


def test_likeness_estimates_shared_phrases():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(1000)]
    a, b = " ".join(words), " ".join(words[:700] + [w[::-1] for w in words[700:]])
    pa_, pb = lz_fingerprint.phrases(a), lz_fingerprint.phrases(b)
    true = len(pa_ & pb) / len(pa_ | pb)
    assert abs(lz_fingerprint.likeness(lz_fingerprint.signature(pa_), lz_fingerprint.signature(pb)) - true) < 0.15


# the pipeline


def _labelled(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out() & F.col("toxic").isNotNull())
    return [tuple(r) for r in labels.join(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id").select("doc_id", "toxic", "text").collect()]


def _vote(index, rows, counts):
    """The score by brute force over all examples (the table has fewer than the bound)."""
    if not counts:
        return index.blank
    y = {i: v for i, v, _ in rows}
    sims = sorted(((x, i) for i, x in _dense(index, rows, counts).items() if x > 1e-9), reverse=True)[: toxicity.NEAREST]
    votes = [(x * index.weight[y[i]], y[i]) for x, i in sims]
    toxic, clean = (sum(v for v, t in votes if t == k) + toxicity.PRIOR * p for k, p in ((1, index.prior), (0, 1 - index.prior)))
    return 1 / (1 + (clean / toxic) ** index.slope * np.exp(-index.shift))


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, at, seen = docs.columns, docs, []
    for name, stage in corpus_pipeline.STAGES:
        before, at = at, corpus_pipeline.materialize(stage(spark, at, sf_dir), name)
        seen.append(name)
        if name == "toxicity":
            index = toxicity.fit(before, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out()))
            rows = [(i, int(y), toxicity.features(t)) for i, y, t in _labelled(spark, sf_dir)]
            known = [(i, y, {index.vocabulary[f]: n for f, n in c.items() if f in index.vocabulary}) for i, y, c in rows]
            held = {r.doc_id: {index.vocabulary[f]: n for f, n in toxicity.features(r.text).items() if f in index.vocabulary} for r in before.collect()}
            keep = {i for i, c in held.items() if _vote(index, known, c) < toxicity.THRESHOLD}
            assert {r.doc_id for r in at.collect()} == keep
        if name == "line_dedup":
            rows = sorted((r.doc_id, r.text) for r in before.collect())
            assert [r.text for r in at.orderBy("doc_id").collect()] == _whole_runs([t for _, t in rows])
        if name == "simhash_dedup":
            rows = sorted((r.doc_id, r.text) for r in before.collect())
            label = _similar([t for _, t in rows])
            assert {r.doc_id for r in at.collect()} == {rows[i][0] for i in set(label)}
        if name == "mixing":
            copies = {r.doc_id: r.copies for r in mixing.mix(before).where("copies > 0").collect()}
            assert {r.doc_id: r["count"] for r in at.groupBy("doc_id").count().collect()} == copies
        if name != "packing":
            assert at.columns == columns
    assert at.agg(F.sum("length")).first()[0] > 0 and len(seen) == 5


def test_pipeline_stages_on_odd_rows(spark, sf_dir, docs, empty):
    """Nulls, repeated rows and ids, ties, clashing columns; then no rows."""
    import corpus_pipeline

    columns = corpus_pipeline.COLUMNS
    at, none = docs, empty
    for name, stage in corpus_pipeline.STAGES:
        before = at.select(*columns).collect()
        at, none = (corpus_pipeline.materialize(stage(spark, d, sf_dir), name) for d in (at, none))
        assert none.count() == 0 and none.columns == at.columns
        if name == "packing":
            assert at.where("start = 0").count() == len(before)
            break
        assert at.columns == columns
        after = at.collect()
        if name == "toxicity":
            assert sorted(map(repr, after)) == sorted(map(repr, before))  # none of them is toxic
        elif name == "line_dedup":
            assert sorted(map(repr, (r.doc_id for r in after))) == sorted(map(repr, (r.doc_id for r in before)))
            assert all(r.n_chars == len(r.text or "") for r in after) and sum(r.text is None for r in after) == 2
        elif name == "simhash_dedup":
            label = _similar([r.text for r in before])
            assert len(after) == len(set(label))
            at = stage(spark, docs, sf_dir).union(docs.select(*columns))  # for the next stage: repeated rows again
            at = corpus_pipeline.materialize(at, "odd")


# memory


def test_python_workers_get_small_batches(spark):
    """However many rows a partition has; a bound of the session's own holds, and none is left behind."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    def run():
        made = spark.range(0, 4000, 1, 1).selectExpr("id", "repeat('abcd', 1000) text").mapInArrow(sizes, "n long, size long")
        found = materialize(made, "sizes").collect()
        assert sum(r.n for r in found) == 4000
        return max(r.size for r in found)

    assert run() < 2.2 * 2**20 and spark.conf.get(name, None) is None
    spark.conf.set(name, 6 << 20)
    try:
        assert 5 * 2**20 < run() < 6.2 * 2**20 and spark.conf.get(name) == str(6 << 20)
    finally:
        spark.conf.unset(name)


def test_workers_remember_few_words():
    path = packing.default_tokenizer()
    words = [f"w{i}" for i in range(200_000)]
    for i in (0, 100_000):
        packing.encode([" ".join(words[i : i + 100_000])], path)
    assert len(packing._known[path]) <= 1 << 17
    again = packing.encode([" ".join(words[:3]), " ".join(words[-3:])], path)
    assert again == [b"".join(packing._encoders[path]([w])[w] for w in some) for some in (words[:3], words[-3:])]


def test_the_driver_gives_freed_memory_back():
    used = lambda: next(int(x.split()[1]) for x in open("/proc/self/status") if x.startswith("RssAnon")) / 1024
    held = [b"x" * 100_000 for _ in range(1500)]
    kept, full = held[::100], used()
    del held
    toxicity._give_back()
    assert full - used() > 100 and len(kept) == 15
