"""SimHash near-duplicates, candidates by pigeonring filtering (operator 6).

A 64-bit fingerprint is a ring of eight segments of eight bits.  If two
fingerprints differ in at most tau bits, then from some start every chain of l
consecutive segments differs in at most l * tau / 8 bits (the pigeonring
principle).  For tau = 3 the chains of 1 to 5 segments allow 0, 0, 1, 1, 1
bits: the first two segments are equal, and of the next three at most one
differs.  So a key of the start, the two segments and two of the next three,
32 equal bits in all, finds each pair; there are 8 * 3 keys.  A pair that
meets has its whole chain checked, and only then all 64 bits.

Equal fingerprints are one node.  Within a key, nodes near the key's pivot
(its node with most documents) are linked to the pivot and to each other
through it, so that only the rest is compared; a group of near copies gives as
many rows as it has nodes, not their square.  A key that still has many nodes is
split by what further bits must be equal: one of the four segments outside the
key, and then three of the six nibbles outside both, so that 52 of 64 bits are and a
group has at most 4096 nodes however large the table is.  Each split has its own
pivots.  No split drops a pair: only the plan depends on the numbers.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunklake.llm.common import keyed_rows, materialize, table, texts, whole_rows
from chunklake.llm.graph import components

SEED = 42
SEGMENTS, BITS = 8, 8
BLOCK = 1 << 16
#: Groups with more nodes than this are split further before nodes are paired.
CROWD = 32
#: Bands of minimum hashes, and hashes in each.
BANDS, ROWS = 40, 6

_RANDOM = np.random.default_rng(6)
_XOR, _TIMES = (_RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(odd) for odd in (0, 1))
#: Columns of the bits of minimum hashes.
_WORDS_OF_BITS = ("b0", "b1", "b2", "b3")
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of the word shingles of ``text``, block by block; none if it has no word."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    words = (m.group() for m in _WORDS.finditer(data)) if len(data) > BLOCK * 16 else iter(_WORDS.findall(data))
    tail, first = [], True
    digest = xxhash.xxh64_intdigest
    while block := tail + list(islice(words, BLOCK)):
        if len(block) < shingle:
            if first:
                yield np.array([digest(b" ".join(block), SEED)], np.uint64)
            break
        grams = map(b" ".join, zip(*(block[i:] for i in range(shingle)), strict=False))
        yield np.fromiter((digest(g, SEED) for g in grams), np.uint64, len(block) - shingle + 1)
        tail, first = block[len(block) - shingle + 1 :], False


def _fingerprint(blocks: Iterable[np.ndarray]) -> int:
    """The bits that are set in over half of the hashes; 0 if there are none."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in blocks:
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    bits = np.packbits((ones * 2 > n).astype(np.uint8), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles of ``text``; 0 if it has no word.

    Works through the text in blocks, so that memory does not grow with the
    number of shingles.
    """
    return _fingerprint(_hashes(text, shingle))


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "fp"])


def _segment(fp, i: int):
    return F.shiftrightunsigned(fp, (i % SEGMENTS) * BITS).bitwiseAND(255)


def _keys(fp):
    """The 24 chain keys of a fingerprint, each a long: start, skipped segment, 32 bits."""
    keys = []
    for start in range(SEGMENTS):
        for skip in (2, 3, 4):
            key = F.lit(start * 8 + skip).cast("long")
            for step in (s for s in range(5) if s != skip):
                key = F.shiftleft(key, BITS).bitwiseOR(_segment(fp, start + step))
            keys.append(key)
    return F.array(*keys)


def _mask(start: int, length: int) -> int:
    """The bits of ``length`` segments from ``start``, as a signed long."""
    bits = sum(255 << ((start + i) % SEGMENTS * BITS) for i in range(length))
    return bits - (1 << 64) if bits >> 63 else bits


def _chain(a, b, limit: int):
    """Some start has every chain within its share of ``limit`` differing bits.

    The share is a whole number; of the lengths with the same share the longest
    speaks for all.
    """
    shares = {length * limit // SEGMENTS: length for length in range(1, SEGMENTS)}
    ring = F.lit(False)
    for start in range(SEGMENTS):
        held = F.lit(True)
        for share, length in shares.items():
            held = held & (F.bit_count(a.bitwiseXOR(b).bitwiseAND(F.lit(_mask(start, length)))) <= share)
        ring = ring | held
    return ring


def _near(a, b, limit: int):
    return F.bit_count(a.bitwiseXOR(b)) <= limit


def links(nodes: DataFrame, limit: int = 3) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within ``limit`` bits.

    ``nodes``: distinct ``fp`` with ``n``, its documents.  ``limit`` is at most 3,
    which the keys are made for.
    """
    if limit > 3:
        raise ValueError("the chain keys are complete up to three differing bits")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Dealt out first: each row becomes 24.
    keyed = nodes.repartition(parts, "fp").select("fp", "n", F.explode(_keys(F.col("fp"))).alias("key"))
    rows, names, out = _thinned(keyed, ["key"], limit), ["key"], []
    for split, more in ((_other_segment, "sub"), (_other_nibbles, "nibbles"), (None, None)):
        few = rows.where(F.col("size") <= CROWD) if split else rows
        stars = rows.where("reached and fp <> pivot").select(F.col("pivot").alias("a"), F.col("fp").alias("b"))
        # Written for each split: one plan over all of them would fill the driver's memory.
        out.append(materialize(stars.union(_pairs(few, names, limit)).distinct(), "links"))
        # A group whose nodes are all reached has no pair left.
        crowd = rows.where((F.col("size") > CROWD) & (F.col("left") > 0))
        if split is None or crowd.isEmpty():
            break
        names = [*names, more]
        rows = _thinned(split(crowd).select(*names, "fp", "n"), names, limit)
    return reduce(DataFrame.union, out).distinct()


def _thinned(rows: DataFrame, on: list[str], limit: int) -> DataFrame:
    """``rows`` (on, fp, n) of groups of two or more, with ``size``, ``pivot``, ``reached`` and ``left``, those not reached.

    Two reached nodes are in one component already, so of a pair one is not.
    """
    stats = rows.groupBy(*on).agg(F.count("*").alias("size"), F.max(F.struct("n", "fp")).alias("p")).where("size > 1")
    met = rows.join(stats, on).select(*on, "fp", "n", "size", F.col("p.fp").alias("pivot"))
    met = materialize(met.withColumn("reached", _near(F.col("fp"), F.col("pivot"), limit)), "chain-keys")
    rest = met.where("not reached").groupBy(*on).agg(F.count("*").alias("left"))
    return met.join(rest, on, "left").withColumn("left", F.coalesce("left", F.lit(0)))


def _other_segment(rows: DataFrame) -> DataFrame:
    """Outside the key are four segments; of at most three differing bits, one segment has none."""
    coded = rows.selectExpr("*", "cast(shiftrightunsigned(key, 32) as int) as code").selectExpr("*", "code div 8 as start", "code % 8 as skip")
    sub = """explode(transform(array(skip, 5, 6, 7), s -> struct((start + s) % 8 as at,
        shiftrightunsigned(fp, ((start + s) % 8) * 8) & 255 as bits)))"""
    return coded.selectExpr("*", f"{sub} as sub")


def _other_nibbles(rows: DataFrame) -> DataFrame:
    """Outside key and segment are six nibbles; three of them at least are equal."""
    coded = rows.selectExpr("*", "cast(shiftrightunsigned(key, 32) as int) as code").selectExpr("*", "code div 8 as start", "code % 8 as skip")
    free = "flatten(transform(filter(array(skip, 5, 6, 7), s -> (start + s) % 8 <> sub.at), s -> array(((start + s) % 8) * 8, ((start + s) % 8) * 8 + 4)))"
    coded = coded.selectExpr("*", f"transform({free}, s -> shiftrightunsigned(fp, s) & 15) as free")
    chosen = ", ".join(f"struct({n} as which, free[{a}] * 256 + free[{b}] * 16 + free[{c}] as bits)" for n, (a, b, c) in enumerate(combinations(range(6), 3)))
    return coded.selectExpr("*", f"explode(array({chosen})) as nibbles")


def _pairs(rows: DataFrame, on: list[str], limit: int) -> DataFrame:
    a = rows.where("not reached").select(*on, F.col("fp").alias("a"))
    b = rows.where("left > 0").select(*on, F.col("fp").alias("b"))
    near = _chain(F.col("a"), F.col("b"), limit) & _near(F.col("a"), F.col("b"), limit)
    return a.join(b, on).where((F.col("a") != F.col("b")) & near).select("a", "b")


def classes(docs: DataFrame, shingle: int = 3, limit: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each row of ``docs``.

    Null texts are empty; texts without a word have fingerprint zero and are
    linked like any other.  Rows with equal ``doc_id`` stay apart; a component
    of null ids only has a null id.
    """
    marked = texts(docs).mapInArrow(lambda it: _fingerprints(it, shingle), "doc_id long, fp long")
    marked = materialize(marked, "fingerprints")
    nodes = materialize(marked.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")), "nodes")
    parts = components(links(nodes, limit))
    least = nodes.join(parts, nodes.fp == parts.node, "left").select("fp", F.coalesce("component", "fp").alias("part"), "least")
    first = least.groupBy("part").agg(F.min("least").alias("component_id"))
    named = materialize(least.join(first, "part").select("fp", "component_id"), "fingerprint-classes")
    return marked.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The different shingles of ``text`` by their 64-bit hashes, sorted."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *_hashes(text, shingle)]))


def sketch(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a set of hashes a key for each band, which is a hash of the band's least values, and a bit for each
    least value, in four words; no keys without hashes."""
    if not len(hashes):
        return np.zeros(0, np.uint64), np.zeros(4, np.uint64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 1024):
        np.minimum(least, ((hashes[i : i + 1024, None] ^ _XOR) * _TIMES).min(axis=0), out=least)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ column) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    mixed = (least ^ (least >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    bits = np.zeros(256, np.uint8)
    bits[: len(mixed)] = mixed >> np.uint64(63)
    return keys, np.packbits(bits).view(np.uint64)


def _sketches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t, shingle) for t in batch.column("text").to_pylist()]
        made = [sketch(s) for s in sets]
        bits = np.array([b for _, b in made], np.uint64).view(np.int64).reshape(len(sets), 4)
        columns = [
            batch.column("doc_id"),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
            pa.array(np.array([_fingerprint([s]) for s in sets], np.uint64).view(np.int64)),
            pa.array([k.view(np.int64) for k, _ in made], pa.list_(pa.int64())),
            *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(4)],
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "size", "digest", "fp", "bands", *_WORDS_OF_BITS])


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t, shingle).view(np.int64) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "hashes"])


def allowance(similarity: float) -> int:
    """Bits in which fingerprints of sets of that similarity differ, and five deviations more.

    Two sets of equal size with similarity s have a cosine of 2 s / (1 + s); each
    bit differs with the share that their angle has of half a turn.
    """
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return min(64, math.ceil(64 * p + 5 * math.sqrt(64 * p * (1 - p))))


def bits_allowed(similarity: float) -> int:
    """Bits in which sets of that similarity differ of those of their least values, and five deviations more:
    a least value is shared with a probability of the similarity, and otherwise its bit is by chance."""
    n, p = BANDS * ROWS, (1 - similarity) / 2
    return math.ceil(n * p + 5 * math.sqrt(n * p * (1 - p)))


def _verified(pairs: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose shingle sets have the similarity, by whole sets."""
    pairs = materialize(pairs.distinct(), "candidates")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    chosen = docs.join(wanted, "doc_id", "left_semi").select("doc_id", "text")
    sets = materialize(chosen.mapInArrow(lambda it: _sets(it, shingle), "doc_id long, hashes array<long>"), "shingle-sets")
    one, two = (sets.select(F.col("doc_id").alias(c), F.col("hashes").alias(f"hashes_{c}")) for c in ("a", "b"))
    shared = F.size(F.array_intersect("hashes_a", "hashes_b"))
    share = shared / (F.size("hashes_a") + F.size("hashes_b") - shared)
    return materialize(pairs.join(two, "b").join(one, "a").where(share >= similarity).select("a", "b"), "similar-links")


def _by_prefix(nodes: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """``nodes`` with ``token``, a shingle's hash, its ``place`` and ``left``: a row for each of a node's rarest shingles, one more than it may
    lack of a set that similar; of two sets with the similarity one is common to both.

    Shingles are in the order of how many of the nodes hold them.  Texts that are edited at random have
    shingles of their own at the first places, so that the first which two half-alike texts have in common leaves too few
    after it.  ``left`` says
    that a node is not in the component that most nodes of the token are in.
    """
    nodes = materialize(nodes, "crowd-nodes")
    sets = docs.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "text")
    sets = materialize(sets.mapInArrow(lambda it: _sets(it, shingle), "doc_id long, hashes array<long>"), "crowd-sets")
    tokens = sets.select(F.col("doc_id").alias("node"), F.explode("hashes").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("holders"))
    # A text's shingles are in one task, as its text is.
    place = F.row_number().over(Window.partitionBy("node").orderBy("holders", "token"))
    ranked = tokens.join(counts, "token").withColumn("place", place).join(nodes, "node")
    # Tokens that one node holds take up places, but bring it together with none.
    prefix = materialize(ranked.where((F.col("place") <= F.col("size") - F.ceil(F.col("size") * similarity - 1e-9) + 1) & (F.col("holders") > 1)).drop("holders"), "rarest")
    labels = prefix.groupBy("token", "label").agg(F.count("*").alias("n"))
    homes = labels.groupBy("token").agg(F.max(F.struct("n", "label")).alias("home"), F.count("*").alias("labels")).where("labels > 1")
    return prefix.join(homes.select("token", F.col("home.label").alias("home")), "token").withColumn("left", F.col("label") != F.col("home")).drop("home")


def similar_classes(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, component_id) for ``docs``, whose doc_id is unique and not null.

    Texts are linked if the sets of their word shingles have at least the
    ``similarity`` (shared shingles by all); a text with fewer words is one
    shingle, and texts without a word are one class.  Texts with equal sets are
    one node.  At such similarities fingerprints differ in more bits than chain
    keys can hold, so nodes meet by bands of minimum hashes: at 0.8 a pair shares
    one of the 40 with a probability of 0.99999.  Of those that meet, sizes and the pigeonring
    filter prune before all 64 bits are compared; then 240 bits of the minimum hashes, which differ
    more the less alike the sets are, so that few pairs under 0.6 are left, and whole sets decide.

    In each band's group all nodes are compared with the one that has most
    documents; then only pairs that are in different components yet, one of them
    not in that node's, are compared.  Where a group with such nodes has over ``CROWD`` nodes, those of all such
    groups meet by their rarest shingles instead (:func:`_by_prefix`), which loses no pair.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = allowance(similarity)
    docs = texts(docs)
    made = docs.mapInArrow(lambda it: _sketches(it, shingle), "doc_id long, size long, digest binary, fp long, bands array<long>, b0 long, b1 long, b2 long, b3 long")
    made = materialize(made, "sketches")
    members = materialize(made.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count("*").alias("n")), "shingle-nodes")
    nodes = made.drop("digest").join(members.select("node", "n"), F.col("doc_id") == F.col("node")).select("node", "n", "size", "fp", "bands", *_WORDS_OF_BITS)
    nodes = materialize(nodes.repartition(parts, "node"), "sketch-nodes")
    keyed = nodes.select("node", "n", "size", "fp", *_WORDS_OF_BITS, F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").count().where("count > 1").select("key")
    met = materialize(keyed.join(shared, "key"), "bands")

    def near(a: str, b: str):
        sizes = F.least(f"{a}.size", f"{b}.size") >= F.greatest(f"{a}.size", f"{b}.size") * similarity
        apart = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"{a}.{w}").bitwiseXOR(F.col(f"{b}.{w}"))) for w in _WORDS_OF_BITS])
        return sizes & _chain(F.col(f"{a}.fp"), F.col(f"{b}.fp"), limit) & _near(F.col(f"{a}.fp"), F.col(f"{b}.fp"), limit) & (apart <= bits_allowed(similarity))

    held = ("size", "fp", "node", *_WORDS_OF_BITS)
    pivots = met.groupBy("key").agg(F.max(F.struct("n", *held)).alias("p"))
    stars = met.join(pivots, "key").select("key", "p", F.struct(*held).alias("m"))
    stars = stars.where((F.col("m.node") != F.col("p.node")) & near("p", "m"))
    links_ = _verified(stars.select(F.col("p.node").alias("a"), F.col("m.node").alias("b")), docs, shingle, similarity)

    labels = components(links_)
    labelled = met.join(labels, met.node == labels["node"], "left").select(met["*"], F.coalesce("component", met.node).alias("label"))
    labelled = materialize(labelled, "labelled-bands")
    at = labelled.join(pivots, "key").where("node = p.node").select("key", F.col("label").alias("home"))
    labelled = labelled.join(at, "key").withColumn("left", F.col("label") != F.col("home"))
    crowds = labelled.groupBy("key").agg(F.count_if("left").alias("lefts"), F.count("*").alias("members")).where("lefts > 0")
    rows = materialize(labelled.join(crowds, "key"), "rest-bands")

    def pairs(rows: DataFrame, on: list[str], more: Column | None = None) -> DataFrame:
        a = rows.where("left").select(*on, F.struct(*held, "label", "place").alias("x"))
        b = rows.select(*on, F.struct(*held, "label", "left", "place").alias("y"))
        apart = (F.col("x.label") != F.col("y.label")) & (~F.col("y.left") | (F.col("x.node") < F.col("y.node")))
        return a.join(b, on).where((apart if more is None else apart & more) & near("x", "y")).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))

    more = pairs(rows.where(F.col("members") <= CROWD).withColumn("place", F.lit(0)), ["key"])
    crowded = rows.where(F.col("members") > CROWD)
    if not crowded.isEmpty():
        # From the first common shingle on there must be as many as the similarity asks for.
        rest = 1 + F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
        enough = rest >= (F.col("x.size") + F.col("y.size")) * (similarity / (1 + similarity)) - 1e-6
        more = more.union(pairs(_by_prefix(crowded.select(*held, "label").distinct(), docs, shingle, similarity), ["token"], enough))
    parted = components(links_.union(_verified(more, docs, shingle, similarity)))
    found = made.select("doc_id", "digest").join(members.select("digest", "node"), "digest").select("doc_id", "node")
    return found.join(parted, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component_id"))


def _one_of_each(docs: DataFrame, find) -> DataFrame:
    """``docs`` with one row of each class that ``find`` gives: the one with the least id (null: the
    greatest), of rows that share it the first."""
    keyed = keyed_rows(whole_rows(docs, "doc_id", "text"))
    found = find(keyed.withColumn("doc_id", F.col("_row"))).select(F.col("doc_id").alias("_row"), "component_id")
    order = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("least")
    kept = keyed.select("_row", "doc_id").join(found, "_row").groupBy("component_id").agg(order).select("least._row")
    return keyed.join(kept, "_row", "left_semi").select("whole.*")


def dedup(docs: DataFrame, shingle: int = 3, limit: int = 3) -> DataFrame:
    """``docs`` with one row of each class of :func:`classes`."""
    return _one_of_each(docs, lambda rows: classes(rows, shingle, limit))


def dedup_similar(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each class of :func:`similar_classes`."""
    return _one_of_each(docs, lambda rows: similar_classes(rows, shingle, similarity))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))


QUERIES = {"op6_simhash_dedup": op6_simhash_dedup}
ORACLE_SQL: dict[str, str] = {}
