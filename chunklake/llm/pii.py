"""Personal data by bootstrapped contextual extraction (operator 5).

Fixed expressions find seed entities.  Every token that looks like an identifier
is noted with its lexical contexts, seeds among them.  Spark then scores the
graph of patterns (contexts) and instances (token surfaces) in rounds: a pattern
scores the share of a kind among what it surrounds, an instance the best of its
patterns.  Patterns that end with a high score and enough different seeds mark
the other tokens in them as personal data of that kind.

Secrets (keys, access tokens) have no expression that is sure: long runs of
hexadecimal digits and key ids are seeds that count in the graph, but are only
reported where a confident pattern holds them.  Their patterns are also how the
token begins, and a name before = or : in the same word.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.llm.common import materialize, table, texts

#: Kinds of the fixed expressions, then the one that only patterns confirm.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE = 4
ROUNDS = 3
#: Patterns count from this score, and from this many different seeds.
CONFIDENT, SEEDS = 0.8, 5
#: Patterns that are expected to count by accident, of each kind, at most.
CHANCE = 0.01
#: Words of a context that are longer stand in it as their hash.
SPELLED = 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits, so a long run is read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]+")
_DIGITS = re.compile(r"[^0-9]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the seed entities, by kind, then start."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            found.append((0, start, m.end()))
            done = m.end()
        at = text.find("@", m.end() if m else at + 1)
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in m.group().split(".")):
            found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := _DIGITS.sub("", m.group())) <= 19 and _luhn(digits):
            found.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m.group())) <= 15:
            found.append((3, m.start(), m.end()))
    return found


_SECRET = re.compile(r"(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{16,}|AKIA[0-9A-Z]{16}")
_NAMED = re.compile(r"[A-Za-z][A-Za-z0-9_.-]*[=:]+")
_PREFIX = re.compile(r"[A-Za-z]{2,4}[_-]?")
_RUNS = re.compile(r"[^\W\d_]+|\d+|\s+")


def _hash(word: str) -> str:
    return f"{xxhash.xxh64_intdigest(word.encode('utf-8', 'surrogatepass')):016x}"


def _shape(token: str) -> str:
    """Letters as a, digits as 9, each run once; other characters are themselves."""
    return _RUNS.sub(lambda m: "9" if m.group()[0].isdigit() else " " if m.group().isspace() else "a", token)


def _outer(text: str, start: int, end: int) -> tuple[int, int]:
    """The whole words that a span lies in."""
    while start > 0 and not text[start - 1].isspace():
        start -= 1
    while end < len(text) and not text[end].isspace():
        end += 1
    return start, end


def _before(text: str, at: int) -> tuple[str, int]:
    """The word before place ``at``, and where it starts; ('', 0) if there is none."""
    while at > 0 and text[at - 1].isspace():
        at -= 1
    start, _ = _outer(text, at, at)
    return text[start:at].lower(), start


def _after(text: str, at: int) -> str:
    while at < len(text) and text[at].isspace():
        at += 1
    return text[at : _outer(text, at, at)[1]].lower()


def contexts(text: str, start: int, end: int) -> list[str]:
    """The patterns around the whole words that a span lies in: two words before; one;
    the one before that; one on either side; one after; one before and the token's shape."""
    shape = _shape(text[start:end].lower())
    start, end = _outer(text, start, end)
    one, at = _before(text, start)
    two, _ = _before(text, at)
    after = _after(text, end)
    one, two, after, shape = (w if len(w) <= SPELLED else f"#{_hash(w)}" for w in (one, two, after, shape))
    out = []
    if one:
        out += [f"{one} _", f"{one} _ is {shape}"]
        out += [f"{two} {one} _", f"{two} * _"] if two else []
        out += [f"{one} _ {after}"] if after else []
    return out + ([f"_ {after}"] if after else [])


def tokens(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds, and other tokens with a digit or an @, with their contexts; a surface is a hash of the whole token."""
    out = []

    def note(kind: int | None, start: int, end: int) -> None:
        out.append({"kind": kind, "start": start, "end": end, "surface": _hash(text[start:end].lower()), "patterns": contexts(text, start, end)})

    for kind, start, end in base:
        note(kind, start, end)
    taken, i, done = sorted((s, e) for _, s, e in base), 0, 0
    for m in _MARK.finditer(text):
        if m.start() < done:
            continue
        start, end = _outer(text, m.start(), m.end())
        done = end
        while end > start and not text[end - 1].isalnum():
            end -= 1
        while start < end and not (text[start].isalnum() or text[start] == "+"):
            start += 1
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if start < end and not (i < len(taken) and taken[i][0] < end):
            name = _NAMED.match(text, start, end)
            start = name.end() if name and name.end() < end else start
            while start < end and not text[start].isalnum():
                start += 1
            note(BASE if _SECRET.fullmatch(text, start, end) else None, start, end)
            named = text[name.start() : start].lower() if name else ""
            more = [f"{named if len(named) <= SPELLED else '#' + _hash(named)}_"] if name else []
            prefix = _PREFIX.match(text, start, end)
            out[-1]["patterns"] += [*more, *([f"{prefix.group()}..."] if prefix and prefix.end() < end else [])]
    return out


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_TOKEN = pa.struct([*_SPAN, ("surface", pa.string()), ("patterns", pa.list_(pa.string()))])
_FIELDS = """doc_id long, part long, seq long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string,
    base array<struct<kind: int, start: long, end: long>>,
    tokens array<struct<kind: int, start: long, end: long, surface: string, patterns: array<string>>>"""


def digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seq = TaskContext.get().partitionId(), 0
    names = ["doc_id", "part", "seq", *(f"n_{k}" for k in KINDS[:BASE]), "base_sha256", "base", "tokens"]
    for batch in batches:
        text = batch.column("text").to_pylist()
        base = [base_spans(t) for t in text]
        counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in range(BASE)]
        spans = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in b] for b in base], pa.list_(_SPAN))
        noted = pa.array([tokens(t, b) for t, b in zip(text, base, strict=True)], pa.list_(_TOKEN))
        hashes = pa.array([hashlib.sha256(digest(b).encode()).hexdigest() for b in base], pa.string())
        n = len(text)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([part] * n, pa.int64()), pa.array(range(seq, seq + n), pa.int64()), *counts, hashes, spans, noted], names)
        seq += n


def _beyond_chance(seeds, surfaces, rate):
    """The logarithm of Chernoff's bound that ``seeds`` of ``surfaces`` are of a kind with this share, turned round; 0 where they are no more than expected."""
    q = seeds / surfaces
    part = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(0.0)
    return F.when(q > rate, surfaces * (part(q, rate) + part(1 - q, 1 - rate))).otherwise(0.0)


def patterns(noted: DataFrame, rounds: int = ROUNDS, confident: float = CONFIDENT, seeds: int = SEEDS, chance: float = CHANCE) -> DataFrame:
    """(kind, pattern, score) of the patterns that count, from tokens with ``pattern``.

    The graph has an edge for each pattern and surface.  Each round is two
    joins on it; edges are counted before they are shuffled.  A pattern counts
    with ``seeds`` different surfaces of the kind, if of all patterns with as many
    surfaces at most ``chance`` are expected to have such a share by accident.
    """
    edges = materialize(noted.groupBy("pattern", "surface").agg(F.count("*").alias("n")), "edges")
    known = materialize(noted.where("kind is not null").select("surface", "kind").distinct(), "seeds")
    all_ = materialize(edges.groupBy("pattern").agg(F.sum("n").alias("total"), F.count("*").alias("surfaces")).where(F.col("surfaces") >= seeds), "pattern-totals")
    surfaces, tried = edges.select("surface").distinct().count(), all_.count()
    # A number for each kind.
    rates = {r.kind: r["count"] / surfaces for r in known.groupBy("kind").count().collect()}
    rate = F.coalesce(*(F.when(F.col("kind") == k, F.lit(min(x, 1 - 1e-9))) for k, x in rates.items()), F.lit(0.5))
    score = known.withColumn("x", F.lit(1.0))
    for turn in range(rounds):
        # Patterns: what share of their tokens is of the kind; one more counts against them.
        held = edges.join(score, "surface").groupBy("pattern", "kind").agg(F.sum(F.col("n") * F.col("x")).alias("hits"), F.count(F.when(F.col("x") >= confident, 1)).alias("seeds"))
        held = held.where(F.col("seeds") >= seeds).join(all_, "pattern").where(_beyond_chance(F.col("seeds"), F.col("surfaces"), rate) >= math.log(max(tried, 1) / chance))
        held = held.select("pattern", "kind", (F.col("hits") / (F.col("total") + 1)).alias("score"))
        held = materialize(held, "pattern-scores")
        if turn + 1 < rounds:
            # Instances: seeds stay; others have the best of their patterns.
            more = edges.join(held, "pattern").groupBy("surface", "kind").agg(F.max("score").alias("x"))
            score = materialize(known.withColumn("x", F.lit(1.0)).union(more).groupBy("surface", "kind").agg(F.max("x").alias("x")), "instance-scores")
    return held.where(F.col("score") >= confident).select("kind", "pattern", "score")


def extract(docs: DataFrame, rounds: int = ROUNDS, confident: float = CONFIDENT, seeds: int = SEEDS) -> DataFrame:
    """A row for each row of ``docs``: its seeds' counts and digest, and ``found``, all spans.

    Null texts are empty.  ``found`` has (kind, start, end) in code points, by
    kind and start: the seeds, and the tokens that confident patterns surround,
    of the kind of the best pattern.
    """
    scanned = materialize(texts(docs).mapInArrow(_scan, _FIELDS), "scanned")
    noted = scanned.select("part", "seq", F.explode("tokens").alias("t")).select("part", "seq", "t.*").withColumn("pattern", F.explode("patterns")).drop("patterns")
    good = patterns(noted.select("pattern", "surface", "kind"), rounds, confident, seeds)
    new = noted.where(F.coalesce("kind", F.lit(BASE)) == BASE).drop("kind").join(good, "pattern")
    new = new.groupBy("part", "seq", "start", "end").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("best"))
    new = new.select("part", "seq", F.struct((-F.col("best.k")).alias("kind"), "start", "end").alias("span"))
    new = new.groupBy("part", "seq").agg(F.collect_list("span").alias("new"))
    none = F.array().cast("array<struct<kind: int, start: long, end: long>>")
    joined = scanned.drop("tokens").join(new, ["part", "seq"], "left")
    return joined.withColumn("found", F.array_sort(F.concat("base", F.coalesce("new", none)))).drop("part", "seq", "new")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "documents"))
    kinds = F.array(*map(F.lit, KINDS))
    span = F.transform("found", lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"]))
    n_new = F.size("found") - F.size("base")
    return found.select("doc_id", *(f"n_{k}" for k in KINDS[:BASE]), "base_sha256", F.array_join(span, ",").alias("spans"), n_new.cast("long").alias("n_found"))


QUERIES = {"op5_pii": op5_pii}
ORACLE_SQL: dict[str, str] = {}
