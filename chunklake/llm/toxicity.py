"""Toxicity by nearest labelled examples, exact TF-IDF cosine (operator 8).

The features of a text are its words.  A bounded sample of labelled texts gives
the examples; the vocabulary is all of their words, and how many documents
hold each is counted over all documents.  A word's weight is its inverse document
frequency times how far the examples tie it to a label: its squared log odds,
shrunk towards nothing the smoother the less evidence there is.  No word is left out,
so that every text has neighbours among the examples.

The examples lie in an inverted index.  Words that many examples hold are kept as
rows of a matrix with the largest weight of each block of examples; the others as
posting lists.  For a document the posting lists are summed exactly, the blocks'
largest weights bound what the other words can add, and only examples that the bound lets
among the nearest are completed: the neighbours are exact.
"""

from __future__ import annotations

import copy
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.llm.common import give_back as _give_back
from chunklake.llm.common import keyed_rows, materialize, table

#: Labelled texts that are kept as examples, at most, half of them toxic; longer ones, in characters, are no examples.
EXAMPLES, LONGEST = 4096, 1 << 16
NEAREST = 15
BLOCK = 16
#: Words that more than one in so many examples hold have a row in the matrix.
COMMON = 16
#: Weight of a word without a tie to the label; log odds of so many deviations keep half their weight.
LEAST, HALF = 0.01, 4.5
#: Weight of the share of toxic examples beside the votes, in units of cosine.
PRIOR = 0.5
THRESHOLD = 0.3

_WORDS = re.compile(r"\w+")

#: Numbers of words and how often each occurs, in two arrays.
Counts = tuple[np.ndarray, np.ndarray]


def features(text: str) -> Counter:
    """The words of the lower-cased text, counted."""
    return Counter(_WORDS.findall(text.lower()))


def counter(vocabulary: dict[str, int]):
    """A function that counts a text's words that the vocabulary has."""

    def count(text: str) -> Counts:
        found = Counter(map(vocabulary.get, _WORDS.findall(text.lower())))
        found.pop(None, None)
        return np.fromiter(found.keys(), np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found))

    return count


def ties(p: np.ndarray, q: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """How far words are tied to a label that are in ``p`` of ``n1`` toxic and ``q`` of ``n0`` other texts.

    The squared difference of the log odds, times z^4 / (z^4 + HALF^4) where z is that difference in deviations: most
    words are chance, and what is a few deviations off in so many of them still is.  ``LEAST`` is added, so that none is nothing.
    """
    odds = np.log((p + 0.5) / (n1 - p + 0.5)) - np.log((q + 0.5) / (n0 - q + 0.5))
    z4 = (odds**2 / (1 / (p + 0.5) + 1 / (q + 0.5) + 1 / (n1 - p + 0.5) + 1 / (n0 - q + 0.5))) ** 2
    return LEAST + odds**2 * z4 / (z4 + HALF**4)


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of runs that begin at ``starts``."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class Index:
    """Unit weighted TF-IDF vectors of the examples."""

    def __init__(self, vocabulary: dict[str, int], df: np.ndarray, n_docs: int, rows: list[tuple[int, int, Counts]], prior: float, share: float | None = None, tie: np.ndarray | None = None):
        """rows: (doc_id, label, word counts) of each example; ``prior`` and ``share`` of the labels
        and of the examples are toxic, and votes make up for it; ``tie``: a factor for each word."""
        self.vocabulary, self.prior = vocabulary, prior
        share = prior if share is None else share
        self.weight = np.array([(1 - prior) / max(1 - share, 1e-9), prior / max(share, 1e-9)])
        self.idf = np.log((1 + n_docs) / (1 + df)) + 1e-3
        self.factor = self.idf if tie is None else self.idf * tie
        # Examples without a word have no neighbours; their labels are the score of such texts.
        bare = np.bincount([y for _, y, c in rows if not len(c[0])], minlength=2)
        votes = bare * self.weight
        self.blank = float((votes[1] + prior) / (votes.sum() + 1))
        rows = [r for r in rows if len(r[2][0])]
        # Examples with the same label and like words share blocks: bounds get tighter.
        leading = {id(r): int(f[np.argmax(w)]) for r in rows for f, w in [self.vector(r[2])]}
        rows.sort(key=lambda r: (r[1], leading[id(r)], r[0]))
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.y = np.array([r[1] for r in rows], float)
        self.blocks = -(-len(rows) // BLOCK) or 1
        vectors = [self.vector(c) for _, _, c in rows]
        f = np.concatenate([np.zeros(0, np.int64), *[v for v, _ in vectors]])
        w = np.concatenate([np.zeros(0), *[x for _, x in vectors]])
        at = np.repeat(np.arange(len(rows), dtype=np.int32), [len(v) for v, _ in vectors])
        del vectors
        common = np.bincount(f, minlength=len(vocabulary)) * COMMON > len(rows)
        #: A common word's row, -1 for others.
        self.row = np.where(common, np.cumsum(common) - 1, -1)
        self.matrix = np.zeros((int(common.sum()), self.blocks * BLOCK))
        self.matrix[self.row[f[common[f]]], at[common[f]]] = w[common[f]]
        self.most = self.matrix.reshape(-1, self.blocks, BLOCK).max(2) if len(self.matrix) else np.zeros((0, self.blocks))
        f, w, at = f[~common[f]], w[~common[f]], at[~common[f]]
        order = np.argsort(f, kind="stable")
        self.posted, self.posted_weight = at[order].astype(np.int32), w[order]
        self.start = np.searchsorted(f[order], np.arange(len(vocabulary) + 1))
        self.slope, self.shift = 1.0, 0.0
        self._calibrate(rows)

    def vector(self, counts: Counts) -> tuple[np.ndarray, np.ndarray]:
        f, n = counts
        w = (1 + np.log(n)) * self.factor[f]
        return f, w / np.sqrt((w * w).sum())

    def nearest(self, counts: Counts, k: int = NEAREST, skip: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the ``k`` nearest examples with a cosine above 0, without those of the id ``skip``."""
        f, w = self.vector(counts)
        rows, n = self.row[f], len(self.ids)
        rare = rows < 0
        lengths = self.start[f[rare] + 1] - self.start[f[rare]]
        places = _runs(self.start[f[rare]], lengths)
        sums = np.bincount(self.posted[places], self.posted_weight[places] * np.repeat(w[rare], lengths), minlength=n)
        rows, w = rows[~rare], w[~rare]
        bound = sums + np.repeat(w @ self.most[rows], BLOCK)[:n]
        if skip is not None:
            bound[self.ids == skip] = -1.0
        # The k-th best of some that look best is one that all of the nearest reach.
        some = np.argpartition(-bound, 4 * k)[: 4 * k] if n > 4 * k else np.arange(n)
        exact = sums[some] + w @ self.matrix[np.ix_(rows, some)]
        exact = exact[bound[some] >= 0]
        least = np.partition(exact, len(exact) - k)[len(exact) - k] if len(exact) >= k else 0.0
        at = np.flatnonzero(bound >= max(least - 1e-12, 0.0))
        sims = sums[at] + w @ self.matrix[np.ix_(rows, at)]
        at, sims = at[sims > 1e-9], sims[sims > 1e-9]
        order = np.lexsort((at, -sims))[:k]
        return at[order], sims[order]

    def _logit(self, at: np.ndarray, sims: np.ndarray) -> float:
        """Log odds of toxic among these neighbours, weighted by cosine and shrunk to the base rate."""
        votes = sims * self.weight[self.y[at].astype(int)]
        toxic = votes @ self.y[at]
        prior = min(max(self.prior, 1e-6), 1 - 1e-6)
        return float(np.log((toxic + PRIOR * prior) / (votes.sum() - toxic + PRIOR * (1 - prior))))

    def _calibrate(self, rows: list) -> None:
        """Fit slope and shift of the log odds to the examples' labels, each scored without itself."""
        if len({y for _, y, _ in rows}) < 2:
            return
        x = np.array([self._logit(*self.nearest(counts, skip=i)) for i, _, counts in rows])
        w, p = self.weight[self.y.astype(int)], np.array([1.0, 0.0])
        z = np.stack([x, np.ones_like(x)], 1)
        for _ in range(30):  # Newton's method on the weighted logistic loss; a little ridge towards (1, 0)
            q = 1 / (1 + np.exp(-np.clip(z @ p, -30, 30)))
            gradient = z.T @ (w * (q - self.y)) + (p - [1, 0])
            p = p - np.linalg.solve((z * (w * q * (1 - q))[:, None]).T @ z + np.eye(2), gradient)
        if p[0] > 0:
            self.slope, self.shift = float(p[0]), float(p[1])

    def score(self, counts: Counts, skip: int | None = None) -> tuple[float, list[int]]:
        """The nearest examples' votes, weighted by cosine and calibrated, and the three nearest."""
        if not len(counts[0]) or not len(self.ids):
            return self.blank, []
        at, sims = self.nearest(counts, skip=skip)
        odds = self.slope * self._logit(at, sims) + self.shift
        return float(1 / (1 + np.exp(-np.clip(odds, -500, 500)))), [int(i) for i in self.ids[at[:3]]]


@dataclass
class Learned:
    """What the labelled sample gives: the words of its examples and their ties to a label, the examples
    (doc_id, label, counts), and the share of toxic labels."""

    vocabulary: dict[str, int]
    tie: np.ndarray
    rows: list[tuple[int, int, Counts]]
    prior: float

    def index(self, df: np.ndarray, n_docs: int) -> Index:
        share = sum(y for _, y, _ in self.rows) / max(1, len(self.rows))
        return Index(self.vocabulary, df, n_docs, self.rows, self.prior, share, self.tie)


def _example_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, ys, texts_ = (batch.column(c).to_pylist() for c in ("_row", "toxic", "text"))
        for r, y, t in zip(rows, ys, texts_, strict=True):
            f = features(t)
            # Near copies mostly share the least hash of five words, and count as one text.
            words = _WORDS.findall(t.lower())
            runs = (" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4)))
            like = min(map(xxhash.xxh64_intdigest, runs)) - (1 << 63)
            cols = [pa.array([v] * len(f), pa.int64()) for v in (r, y, like)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(f.keys(), pa.string()), pa.array(f.values(), pa.int64())], ["_row", "toxic", "alike", "word", "n"])


def learn(keyed: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Learned:
    """Learn from ``labels`` (doc_id, toxic) and the texts of ``keyed`` (_row, doc_id, text).

    Labels with a null in either column are left out; of several for one id the
    highest counts.  The examples are, for either label, the ``examples`` / 2 rows
    with the least hash of id and row (ties by row), without those of over ``LONGEST`` characters, so that
    their texts, words and index have a bounded size; rows that share an id are examples of their own.
    """
    spark = keyed.sparkSession
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    totals = dict(known.groupBy("toxic").count().collect())
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    rows = keyed.select("_row", F.col("doc_id").cast("long").alias("doc_id")).join(known, "doc_id")
    half = [rows.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id", "_row"), "_row").limit(examples // 2) for y in (0, 1)]
    # At most ``examples`` rows of three numbers: collected, so that the choice is fixed, and broadcast.
    chosen = [tuple(r) for h in half for r in h.select("_row", "doc_id", "toxic").collect()]
    sample = keyed.select("_row", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(spark.createDataFrame(chosen, "_row long, doc_id long, toxic long")), "_row")
    sample = materialize(sample.where(F.length("text") <= LONGEST), "example-texts")
    short = {r["_row"] for r in sample.select("_row").collect()}
    chosen = [r for r in chosen if r[0] in short]
    found = materialize(sample.mapInArrow(_example_words, "_row long, toxic long, alike long, word string, n long"), "examples")
    sizes = dict(found.groupBy("toxic").agg(F.count_distinct("alike")).collect())
    by = found.groupBy("word").agg(*[F.count_distinct(F.when(F.col("toxic") == y, F.col("alike"))).alias(c) for y, c in ((1, "p"), (0, "q"))])
    # Words of at most ``examples`` texts of bounded length.
    words = by.orderBy("word").toArrow()
    tie = ties(words["p"].to_numpy().astype(float), words["q"].to_numpy().astype(float), sizes.get(1, 0), sizes.get(0, 0))
    held = found.select("_row", "word", "n").orderBy("_row").toArrow()
    number = pc.index_in(held["word"], words["word"].combine_chunks()).to_numpy().astype(np.int64)
    row, n = held["_row"].to_numpy(), held["n"].to_numpy()
    counts = {r: (number[a:b], n[a:b]) for r, a, b in ((r, *np.searchsorted(row, [r, r + 1])) for r, _, _ in chosen)}
    return Learned({w: i for i, w in enumerate(words["word"].to_pylist())}, tie, [(i, y, counts[r]) for r, i, y in chosen], prior)


def matches(keyed: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """(_row, f, n): which words of the vocabulary each row's text has, and how often; written, so texts are read once."""
    shared = keyed.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, ints = counter(shared.value), pa.list_(pa.int32())
        for batch in batches:
            found = [count(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), *[pa.array([c[i].astype(np.int32) for c in found], ints) for i in range(2)]], ["_row", "f", "n"])

    found = materialize(keyed.select(F.col("_row").cast("long").alias("_row"), "text").mapInArrow(run, "_row long, f array<int>, n array<int>"), "matches")
    shared.unpersist()
    return found


def _scored(keyed: DataFrame, found: DataFrame, index: Index) -> DataFrame:
    """(_row, doc_id, score, evidence) of each row of ``keyed``, from its matches."""
    # Words have their numbers by now.
    bare = copy.copy(index)
    bare.vocabulary = {}
    shared = keyed.sparkSession.sparkContext.broadcast(bare)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f, n = (batch.column(c) for c in ("f", "n"))
            got = [shared.value.score((f[i].values.to_numpy().astype(np.int64), n[i].values.to_numpy())) for i in range(len(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array([s for s, _ in got], pa.float64()), pa.array([e for _, e in got], pa.list_(pa.int64()))], ["_row", "score", "evidence"])

    scores = found.mapInArrow(run, "_row long, score double, evidence array<long>")
    return keyed.select("_row", F.col("doc_id").cast("long").alias("doc_id")).join(scores, "_row")


def _document_counts(found: DataFrame, words: int) -> np.ndarray:
    """In how many rows each word is; each task counts its own rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(words, np.int64)
        for batch in batches:
            counts += np.bincount(batch.column("f").flatten().to_numpy(), minlength=words)
        f = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(counts[f])], ["f", "n"])

    df = np.zeros(words)
    sums = found.mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).toArrow()  # one row for each word
    df[sums["f"].to_numpy()] = sums["n"].to_numpy()
    return df


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Index:
    """An index to score other tables with.  See :func:`learn`, also for ties and repeated rows; document counts are over all rows of ``docs``."""
    keyed = keyed_rows(docs.select("doc_id", "text"))
    learned = learn(keyed, labels, examples)
    return learned.index(_document_counts(matches(keyed, learned.vocabulary), len(learned.vocabulary)), keyed.count())


def score(docs: DataFrame, index: Index) -> DataFrame:
    """(doc_id, score, evidence) for each row: evidence lists the nearest examples' ids, those at earlier places of the index first among equals.

    Null texts are empty; texts without a known word have the score of such
    examples and no evidence.  Repeated rows are scored each.
    """
    keyed = keyed_rows(docs.select("doc_id", "text"))
    return _scored(keyed, matches(keyed, index.vocabulary), index).drop("_row")


def fit_score(keyed: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """:func:`fit` and :func:`score` of one table ``keyed`` (_row, doc_id, text), whose texts are
    read once for both; with ``_row``."""
    learned = learn(keyed, labels, examples)
    _give_back()
    found = matches(keyed, learned.vocabulary)
    scored = _scored(keyed, found, learned.index(_document_counts(found, len(learned.vocabulary)), keyed.count()))
    del learned
    _give_back()
    return scored


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = keyed_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))
    scored = fit_score(keyed, table(spark, sf_dir, "labels").where(~held_out()))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLE_SQL: dict[str, str] = {}
