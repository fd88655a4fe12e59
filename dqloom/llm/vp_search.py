"""Nearest neighbours by vantage-point trees, one tree for each shard.

Largest inner product becomes least distance: every vector gets one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm of its
shard, and queries get 0 there. A tree node holds a vantage point and the median distance to it; a leaf holds up to ``LEAF``
vectors. Queries walk a tree in batches: a batch that stands before a node splits into those nearer to the inside and those
nearer to the outside, goes into the nearer side first, and only queries whose best distances so far reach over the boundary
go into the other side. The triangle inequality is relaxed by ``factor``: the far side is left out if factor * |d - median|
is at least the distance of the k-th best. Factor 1 is exact search, above 1 it prunes more.

Distances only decide where to look: they are rounded against the longest vector, so a leaf ranks by the inner products of the original
vectors, always summed in one order, and pruning leaves a slack for the rounding. With one very long vector the search is
exact too, but the tree of its shard prunes nothing.

A shard's vectors go to one task, which builds their tree, and the blocks of queries follow to it one by one: a tree is sent once, and a task
holds one tree and one block.
Per query and shard at most k candidates come back; they are merged by score, ties by id. Scores are inner products of the
original vectors in double precision.

Nulls and odd input: vectors that are null, empty, zero, or hold a null or non-finite component take no part, neither as query
nor as candidate, nor do vectors whose length differs from the most frequent one (the shortest of equally frequent ones), nor rows with a null id; of rows that
share an id each one is a candidate, but none for a query with the same id; fewer than k candidates are all returned; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import batches_of, table, written

K = 20
EVERY = 20
FACTOR = 1.0
LEAF = 256
SHARD_ROWS = 8_192
QUERY_ROWS = 2_048
SEED = 3


def build(points: np.ndarray, leaf: int = LEAF, seed: int = SEED) -> list[tuple]:
    """Tree as a list of nodes: (vantage row, median, inside node, outside node), or (rows,) for a leaf; node 0 is the root."""
    rng, nodes = np.random.default_rng(seed), []
    work: list[tuple[np.ndarray, int, int]] = [(np.arange(len(points)), -1, 0)]
    while work:
        rows, parent, side = work.pop()
        at = len(nodes)
        if parent >= 0:
            nodes[parent][2 + side] = at
        if len(rows) <= leaf:
            nodes.append([rows])
            continue
        # Of a few candidates, the one whose distances spread most.
        tried = rng.choice(rows, size=min(4, len(rows)), replace=False)
        probe = rng.choice(rows, size=min(200, len(rows)), replace=False)
        spread = [np.var(_distances(points[probe], points[v][None])[:, 0]) for v in tried]
        v = int(tried[int(np.argmax(spread))])
        d = _distances(points[rows], points[v][None])[:, 0]
        median = float(np.median(d))
        inside = d <= median
        if inside.all() or not inside.any():  # copies: no boundary
            nodes.append([rows])
            continue
        nodes.append([v, median, -1, -1])
        work += [(rows[~inside], at, 1), (rows[inside], at, 0)]
    return nodes


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0))


def search(nodes: list, points: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int = K, factor: float = FACTOR, vectors: np.ndarray | None = None, query_vectors: np.ndarray | None = None, scale: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Rows (-1 if none) and distances of the k nearest points of each query, a point with the query's own id left out.

    With vectors and query_vectors the points are ``scale`` times the vectors with the coordinate that makes their norm 1, and the rank is
    by inner product of the vectors. Distances then only prune.
    """
    norms, lift = (queries * queries).sum(1), 1.0
    if vectors is None or query_vectors is None:  # |q - x| falls as q x - |x|^2 / 2 grows
        vectors, query_vectors, lift = np.column_stack([points, (points * points).sum(1) / -2]), np.column_stack([queries, np.ones(len(queries))]), 0.0
    best = np.full((len(queries), k), -np.inf)
    rows_ = np.full((len(queries), k), -1, np.int64)
    reach = np.full(len(queries), np.inf)

    # Slacks for rounding keep factor 1 exact: of distances against the largest norm here, of products against the two norms.
    largest = math.sqrt(max(norms.max(initial=0), (points * points).sum(1).max(initial=0)))
    eps = np.finfo(float).eps
    slack = largest * (2e-6 + 8 * math.sqrt(points.shape[1] * eps))
    sizes, query_sizes = np.sqrt((vectors * vectors).sum(1)), 4 * vectors.shape[1] * eps * np.sqrt((query_vectors * query_vectors).sum(1))

    def look(rows: np.ndarray, q: np.ndarray) -> None:
        # A matrix product says which pairs can matter; those are ranked by products taken in one order.
        s, near = query_vectors[q] @ vectors[rows].T, query_sizes[q][:, None] * sizes[rows][None]
        own = query_ids[q][:, None] == ids[rows][None]
        low = np.where(own, -np.inf, s - near)
        cut = best[q, -1]
        if len(rows) > k:
            cut = np.maximum(cut, np.partition(low, len(rows) - k, axis=1)[:, len(rows) - k])
        at, col = np.nonzero((s + near >= cut[:, None]) & ~own)
        if not len(at):
            return
        some, at = np.unique(at, return_inverse=True)
        counts = np.bincount(at)
        place = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
        found, names = np.full((len(some), counts.max()), -np.inf), np.full((len(some), counts.max()), -1, np.int64)
        names[at, place] = rows[col]
        q = q[some]
        found[at, place] = products(query_vectors, vectors, q[at], rows[col])
        both, names = np.concatenate([best[q], found], axis=1), np.concatenate([rows_[q], names], axis=1)
        idx = np.where(names >= 0, ids[np.maximum(names, 0)], np.iinfo(np.int64).max)
        order = np.lexsort((idx, -both), axis=1)[:, :k]
        best[q], rows_[q] = np.take_along_axis(both, order, 1), np.take_along_axis(names, order, 1)
        reach[q] = np.sqrt(np.maximum(norms[q] + lift - 2 * scale * scale * best[q, -1], 0))

    def walk(node: int, q: np.ndarray) -> None:
        if not len(q):
            return
        if len(nodes[node]) == 1:
            rows = nodes[node][0]
            for i in range(0, len(rows), 4 * LEAF):
                look(rows[i : i + 4 * LEAF], q)
            return
        v, median, inside, outside = nodes[node]
        d = _distances(queries[q], points[v][None])[:, 0]
        inner = d <= median
        for mine, first, second in ((inner, inside, outside), (~inner, outside, inside)):
            own, gap = q[mine], np.abs(d[mine] - median)
            walk(first, own)
            walk(second, own[factor * gap <= reach[own] + slack])

    walk(0, np.arange(len(queries)))
    return rows_, np.sqrt(np.maximum(norms[:, None] + lift - 2 * scale * scale * best, 0))


def products(a: np.ndarray, b: np.ndarray, rows_a: np.ndarray, rows_b: np.ndarray, step: int = 50_000) -> np.ndarray:
    """Inner products of pairs of rows; equal vectors give equal values whatever their place."""
    return np.concatenate([np.einsum("ij,ij->i", a[rows_a[i : i + step]], b[rows_b[i : i + step]]) for i in range(0, max(1, len(rows_a)), step)])


def _scale(x: np.ndarray) -> float:
    """One over the largest norm; of vectors whose squares are beyond what a double holds as well."""
    most = float(np.abs(x).max(initial=0))
    return 1 / most / math.sqrt(float(((x / most) ** 2).sum(1).max())) if most > 0 else 1.0


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    ok = F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)
    ok &= F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.filter(F.coalesce(ok, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, factor: float = FACTOR, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) for the vectors whose id column ``id`` makes is_query true, against all vectors."""
    all_ = _usable(vectors, id_col, vector_col)
    facts = all_.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    schema = "query_id long, vec_id long, score double"
    if not facts:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = int(facts[0]["d"]), int(facts[0]["n"])
    all_ = all_.filter(F.size("v") == dim)
    shards = max(1, math.ceil(n / shard_rows))

    def packed(at: str):
        """One row for each group of vectors: (at, payload)."""

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("id")
            return pd.DataFrame({at: [int(pdf[at].iloc[0])], "payload": [pickle.dumps((pdf["id"].to_numpy(), np.stack(pdf["v"].to_numpy()).astype(np.float64)))]})

        return run

    trees = written(all_.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).groupBy("shard").applyInPandas(packed("shard"), "shard int, payload binary"), "shards")
    queries = written(all_.filter(is_query), "queries")
    blocks = max(1, math.ceil(queries.count() / query_rows))
    asked = queries.withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(blocks)).cast("int")).groupBy("block").applyInPandas(packed("block"), "block int, payload binary")
    # Every block of the stated query set meets every shard; a shard's own row comes first.
    asked = written(asked, "blocks").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select("shard", "block", "payload")
    stream = trees.select("shard", F.lit(-1).alias("block"), "payload").unionByName(asked)
    stream = stream.repartition(shards, "shard").sortWithinPartitions("shard", "block")

    def run(batches):
        ids = x = y = nodes = None
        scale, loaded = 1.0, -1
        for pdf in batches:
            for shard, block, data in zip(pdf["shard"].tolist(), pdf["block"].tolist(), pdf["payload"], strict=True):
                if block < 0:
                    ids, x = pickle.loads(data)
                    scale, loaded = _scale(x), shard
                    y = x * scale
                    y = np.concatenate([y, np.sqrt(np.maximum(1 - (y * y).sum(1), 0))[:, None]], axis=1)
                    nodes = build(y)
                    continue
                if loaded != shard:  # a shard without vectors
                    continue
                query_ids, q = pickle.loads(data)
                z = np.concatenate([q * scale, np.zeros((len(q), 1))], axis=1)
                rows, _ = search(nodes, y, ids, z, query_ids, k, factor, x, q, scale)
                at, col = np.nonzero(rows >= 0)
                rows = rows[at, col]
                for i in range(0, len(at), 50_000):
                    a, r = at[i : i + 50_000], rows[i : i + 50_000]
                    yield pd.DataFrame({"query_id": query_ids[a], "vec_id": ids[r], "score": products(q, x, a, r)})

    with batches_of(vectors.sparkSession, 1):  # a row holds a whole shard
        found = written(stream.mapInPandas(run, schema), "found")
    rank = F.expr("row_number() over (partition by query_id order by score desc, vec_id)")
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % EVERY == 0)
