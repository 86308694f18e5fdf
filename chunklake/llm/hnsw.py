"""Nearest neighbours by a hierarchical navigable small-world graph per shard (operator 1).

Vectors are dealt by hash into shards of bounded size.  A shard's graph is built
in one task, from the top layer down: nodes are inserted block by block, each linked to
neighbours that a walk through the graph as it is so far finds, or that are before it in its
block, thinned so that links go in different directions; layers above hold geometrically fewer nodes.
Graphs are stored as flat neighbour arrays.  Blocks of queries walk each shard's
graph together, and the shards' results are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunklake.llm.common import materialize, table

SHARD = 8192
#: Queries that walk a graph at once, and queries that meet one copy of a graph: their
#: vectors take more bytes than the graph, so copies at most double what is shuffled.
QUERIES_TOGETHER, QUERIES_A_COPY = 1024, 1 << 15
LINKS = 16
BUILD, BEAM = 48, 128
#: Nodes that are inserted together: at first, and at most.
FIRST, INSERTED = 128, 1024


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, rows of ``a`` to rows of ``b``."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T), 0)


def _thin(vectors: np.ndarray, near: np.ndarray, dist: np.ndarray, limit: int) -> np.ndarray:
    """Of each row's candidates, nearest first (-1: none), ``limit`` at most: those
    nearer to the row than to one already taken, then the nearest of the others."""
    n, c = near.shape
    got = vectors[np.maximum(near, 0)]
    square = (got * got).sum(2)
    pair = square[:, :, None] + square[:, None] - 2 * (got @ got.transpose(0, 2, 1))
    closest, taken = np.full((n, c), np.inf, np.float32), np.zeros((n, c), bool)
    for k in range(c):
        ok = (near[:, k] >= 0) & (closest[:, k] > dist[:, k]) & (taken.sum(1) < limit)
        taken[:, k] = ok
        closest[ok] = np.minimum(closest[ok], pair[ok, k])
    rank = np.where(near < 0, 2 * c + 1, np.where(taken, 0, c) + np.arange(c))
    first = np.argsort(rank, axis=1, kind="stable")[:, :limit]
    return np.take_along_axis(near, first, 1)


def _join(vectors: np.ndarray, near: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Add v to the neighbours of u, for each pair, and thin those of every u that gets more than it may have."""
    most, at = near.shape[1], np.unique(u)
    old = near[at]
    one, two = np.concatenate([np.repeat(at, most)[old.ravel() >= 0], u]), np.concatenate([old[old >= 0], v])
    d = ((vectors[one] - vectors[two]) ** 2).sum(1)
    order = np.lexsort((two, d, one))
    one, two, d = one[order], two[order], d[order]
    row, place = np.searchsorted(at, one), np.arange(len(one)) - np.searchsorted(one, one)
    wide = min(int(place.max(initial=0)) + 1, 4 * most)
    found, dist = np.full((len(at), wide), -1, np.int32), np.full((len(at), wide), np.inf, np.float32)
    keep = place < wide
    found[row[keep], place[keep]], dist[row[keep], place[keep]] = two[keep], d[keep]
    for a in range(0, len(at), 256):
        got = _thin(vectors, found[a : a + 256], dist[a : a + 256], most)
        near[at[a : a + 256], : got.shape[1]] = got
        near[at[a : a + 256], got.shape[1] :] = -1


def _grow(vectors: np.ndarray, upper: list[np.ndarray], links: int, most: int) -> np.ndarray:
    """Neighbours of each node of a layer, ``most`` at most (-1: none), inserted block by block.

    A new node's candidates are what a walk through the ``upper`` layers and the layer as it is so far finds,
    and the nodes before it in its own block.
    """
    n, near, have = len(vectors), np.full((len(vectors), most), -1, np.int32), 0
    while have < n:
        end = min(n, have + max(FIRST, min(have // 2, INSERTED)))
        d = _distances(vectors[have:end], vectors[have:end])
        d[np.triu_indices(end - have)] = np.inf
        c = min(BUILD, end - have)
        found = np.argpartition(d, c - 1, axis=1)[:, :c]
        dist = np.take_along_axis(d, found, 1)
        found = np.where(np.isinf(dist), -1, found + have).astype(np.int32)
        if have:
            # Nodes are in the order of their levels: an upper layer's are the first of this one.
            walked = search(vectors[:have], [near[:have], *(upper if upper and len(upper[0]) <= have else [])], vectors[have:end], BUILD)
            to = ((vectors[np.maximum(walked, 0)] - vectors[have:end, None]) ** 2).sum(2)
            found, dist = np.concatenate([found, walked], 1), np.concatenate([dist, np.where(walked < 0, np.inf, to)], 1)
        order = np.argsort(dist, axis=1, kind="stable")[:, :BUILD]
        chosen = np.concatenate([_thin(vectors, f, x, links) for f, x in ((np.take_along_axis(found, order, 1)[a : a + 256], np.take_along_axis(dist, order, 1)[a : a + 256]) for a in range(0, end - have, 256))])
        u, v = np.repeat(np.arange(have, end), chosen.shape[1]), chosen.ravel()
        u, v = u[v >= 0], v[v >= 0]
        if len(u):
            _join(vectors, near, np.concatenate([u, v]), np.concatenate([v, u]))
        have = end
    return near


def build(vectors: np.ndarray, sizes: list[int], links: int = LINKS) -> list[np.ndarray]:
    """Neighbours in each layer, the lowest first.  A layer has the first of the nodes, as many as
    ``sizes`` says; the lowest has all."""
    layers: list[np.ndarray] = []
    for level in reversed(range(len(sizes))):
        layers.insert(0, _grow(vectors[: sizes[level]], layers, links, links if level else 2 * links))
    return layers


def search(vectors: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """The ``beam`` nearest nodes that each query's walk finds, nearest first (-1: none)."""
    q, n = len(queries), len(vectors)
    squares = (vectors * vectors).sum(1)

    def to(nodes: np.ndarray) -> np.ndarray:
        at = np.maximum(nodes, 0)
        d = squares[at] - 2 * np.matmul(vectors[at], queries[:, :, None])[:, :, 0]
        return np.where(nodes < 0, np.inf, d)

    here = np.zeros((q, 1), np.int32)
    best = to(here)
    for near in reversed(layers[1:]):
        while True:
            around = near[here[:, 0]]
            d = to(around)
            k = d.argmin(1)[:, None]
            closer = np.take_along_axis(d, k, 1) < best
            if not closer.any():
                break
            here, best = np.where(closer, np.take_along_axis(around, k, 1), here), np.where(closer, np.take_along_axis(d, k, 1), best)
    near = layers[0]
    seen = np.zeros((q, n + 1), bool)
    rows = np.arange(q)[:, None]
    seen[rows, here] = True
    nodes, dist = np.full((q, beam), -1, np.int32), np.full((q, beam), np.inf)
    nodes[:, :1], dist[:, :1] = here, best
    done = nodes < 0
    while not done.all():
        # the three nearest nodes that have not been left yet
        k = np.argsort(np.where(done, np.inf, dist), axis=1, kind="stable")[:, :3]
        from_ = np.where(np.take_along_axis(done, k, 1), -1, np.take_along_axis(nodes, k, 1))
        np.put_along_axis(done, k, True, 1)
        around = np.where(from_[:, :, None] < 0, -1, near[from_]).reshape(q, -1)
        around = np.where(seen[rows, around], -1, around)
        # a node that two of them lead to counts once
        around = np.sort(around, axis=1)
        around[:, 1:][around[:, 1:] == around[:, :-1]] = -1
        seen[rows, around] = True
        seen[:, -1] = False
        dist, nodes = np.concatenate([dist, to(around)], 1), np.concatenate([nodes, around], 1)
        done = np.concatenate([done, around < 0], 1)
        order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        dist, nodes, done = (np.take_along_axis(x, order, 1) for x in (dist, nodes, done))
    return nodes


_GRAPH = "dim int, shard long, width int, vectors binary, offsets binary, ids binary, sizes array<int>, near array<binary>"


def _walked(vectors: np.ndarray) -> np.ndarray:
    """The vectors as graphs are built and walked with; scores are taken on the given ones."""
    most = float(np.abs(vectors).max(initial=0))
    # Squares of larger components would not fit.
    return (vectors / most if most > 1e15 else vectors).astype(np.float32)


def _build(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    """One shard: equal vectors are one node, with 2 k rows of its least ids, at most k of one id, so that
    k are left without those of any one id."""
    frame = frame.sort_values("vec_id")
    all_ = np.stack(frame["embedding"].to_numpy()).astype(np.float64) + 0.0
    # Vectors are kept as they are given: in 4 bytes a component where that is exact.
    with np.errstate(over="ignore"):
        kind = np.float32 if (all_.astype(np.float32) == all_).all() else np.float64
    all_ = np.ascontiguousarray(all_.astype(kind))
    _, first, node = np.unique(all_.view(f"V{all_.shape[1] * all_.itemsize}").ravel(), return_index=True, return_inverse=True)
    vectors = all_[first]
    order = np.argsort(node, kind="stable")
    own = frame["vec_id"].to_numpy()[order]
    first_of_id = np.flatnonzero(np.concatenate([[True], (np.diff(node[order]) != 0) | (np.diff(own) != 0)]))
    order = order[np.arange(len(order)) - np.repeat(first_of_id, np.diff(np.append(first_of_id, len(order)))) < k]
    order = order[np.arange(len(order)) - np.searchsorted(node[order], node[order]) < 2 * k]
    offsets = np.searchsorted(node[order], np.arange(len(first) + 1))
    # Nodes get levels at random, always the same, and are in the order of their levels.
    levels = np.floor(-np.log(np.maximum(np.random.default_rng(2).random(len(first)), 1e-12)) / math.log(LINKS)).astype(int)
    mix = np.lexsort((np.random.default_rng(1).permutation(len(first)), -levels))
    vectors, levels = vectors[mix], levels[mix]
    ids = [frame["vec_id"].to_numpy()[order[offsets[i] : offsets[i + 1]]] for i in mix]
    layers = build(_walked(vectors), [int((levels >= k).sum()) for k in range(levels[0] + 1)])
    return pd.DataFrame([{
        "dim": vectors.shape[1], "shard": frame["shard"].iloc[0], "width": vectors.itemsize, "vectors": vectors.tobytes(),
        "offsets": np.cumsum([0, *map(len, ids)]).astype(np.int64).tobytes(), "ids": np.concatenate(ids).astype(np.int64).tobytes(),
        "sizes": [len(m) for m in layers], "near": [m.tobytes() for m in layers],
    }])


def _search(queries: pd.DataFrame, graphs: pd.DataFrame, k: int) -> pd.DataFrame:
    out = {"query_id": [], "vec_id": [], "score": []}
    if len(queries) and len(graphs):
        g = graphs.iloc[0]
        vectors = np.frombuffer(g["vectors"], f"f{g['width']}").reshape(-1, g["dim"])
        offsets, ids = np.frombuffer(g["offsets"], np.int64), np.frombuffer(g["ids"], np.int64)
        layers = [np.frombuffer(m, np.int32).reshape(s, -1) for s, m in zip(g["sizes"], g["near"], strict=True)]
        most = float(np.abs(vectors).max(initial=0))
        walked, scale = _walked(vectors), most if most > 1e15 else 1.0
        owns, all_asked = queries["query_id"].to_numpy(), queries["embedding"].to_numpy()
        for at in range(0, len(queries), QUERIES_TOGETHER):
            asked = np.stack(all_asked[at : at + QUERIES_TOGETHER]).astype(np.float64)
            found = search(walked, layers, np.clip(asked / scale, -3e18, 3e18).astype(np.float32))[:, : 3 * k]
            for own, q, nodes in zip(owns[at : at + QUERIES_TOGETHER], asked, found, strict=True):
                nodes = nodes[nodes >= 0]
                exact = np.sqrt(((vectors[nodes].astype(np.float64) - q) ** 2).sum(1))
                many = np.concatenate([ids[offsets[i] : offsets[i + 1]] for i in nodes])
                exact = np.repeat(exact, offsets[nodes + 1] - offsets[nodes])
                keep = many != own
                many, exact = many[keep], exact[keep]
                order = np.lexsort((many, exact))[:k]
                out["query_id"] += [own] * len(order)
                out["vec_id"] += many[order].tolist()
                out["score"] += exact[order].tolist()
    return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def usable(df: DataFrame) -> DataFrame:
    """Rows with an id and a finite vector that is not zero."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound).withColumn("dim", F.size("embedding"))


def index(vectors: DataFrame, shard: int = SHARD, k: int = 10) -> tuple[DataFrame, int]:
    """A row for each shard's graph, and the number of shards.  All usable rows are indexed."""
    sound = usable(vectors)
    shards = max(1, math.ceil(sound.count() / shard))
    dealt = sound.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    return materialize(dealt.groupBy("dim", "shard").applyInPandas(lambda f: _build(f, k), _GRAPH), "graphs"), shards


def nearest(queries: DataFrame, vectors: DataFrame, k: int = 10, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query (vec_id, embedding) the ``k`` nearest
    found, by Euclidean distance, ties to the smaller id; rows with the query's id are not among them.

    Null, zero and non-finite vectors take no part.  Vectors meet queries of
    their own dimension.  Rows that share a vec_id are candidates each; of equal
    vectors in a shard, as many of the least ids as k neighbours of any row may need.  Scores are in double precision on
    the vectors as given, float or double.
    """
    graphs, shards = index(vectors, shard, k)
    asked = usable(queries).withColumnRenamed("vec_id", "query_id")
    blocks = max(1, math.ceil(asked.count() / QUERIES_A_COPY))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>")))
    graphs = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
    keys = ["dim", "shard", "block"]
    found = asked.groupBy(*keys).cogroup(graphs.groupBy(*keys)).applyInPandas(lambda q, g: _search(q, g, k), "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors.where("vec_id % 100 = 0"), vectors)


QUERIES = {"op1_hnsw": op1_hnsw}
ORACLE_SQL: dict[str, str] = {}
