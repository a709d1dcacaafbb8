"""Approximate nearest neighbours: a forest of random-projection trees.

Each tree halves a bounded sample of the vectors by random hyperplanes; every
vector of the table is then routed to its leaf of each tree.  A query walks all
trees through one shared priority queue, ordered by the smallest margin by which
it missed the planes on the way, and so meets the leaves of the whole forest in
order of promise.  The vectors of the leaves that it takes are reranked exactly:
first those of the most promising leaves, whose k-th best score then is the floor
that candidates of the further leaves have to reach.

For the inner product, vectors get one more component, sqrt(M^2 - |x|^2) with M
the largest norm, and queries 0: nearest by angle is then largest by inner
product.  How many leaves a query takes is found on the sample: as many as the
wanted recall needs there.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .vectors import best_pairs, matrix, ranked, valid_vectors

#: Largest numbers of vectors and of queries that meet in one task's block.
BLOCK = 4096


class Forest:
    """Trees as arrays: node k of a tree has the children 2k + 1 and 2k + 2."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        inner, d = (1 << depth) - 1, sample.shape[1]
        self.trees, self.depth = trees, depth
        self.normal = np.zeros((trees, max(inner, 1), d), np.float32)
        self.offset = np.zeros((trees, max(inner, 1)), np.float32)
        for t in range(trees):
            rows = {0: np.arange(len(sample))}
            for node in range(inner):
                own = rows.pop(node)
                w = rng.standard_normal(d)
                if len(own) > 1:  # towards one of two sampled points, from the other
                    a, b = sample[rng.choice(own, 2, replace=False)]
                    if np.any(a != b):
                        w = a - b
                w /= np.linalg.norm(w)
                side = sample[own] @ w
                cut = float(np.median(side)) if len(own) else 0.0
                self.normal[t, node], self.offset[t, node] = w, cut
                right = sample[own] @ self.normal[t, node] >= self.offset[t, node]
                rows[2 * node + 1], rows[2 * node + 2] = own[~right], own[right]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf number in the whole forest of each row of x, for each tree."""
        out = np.zeros((len(x), self.trees), np.int32)
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                margin = np.einsum("ij,ij->i", x, self.normal[t, node]) - self.offset[t, node]
                node = 2 * node + 1 + (margin >= 0)
            out[:, t] = (t << self.depth) + node - ((1 << self.depth) - 1)
        return out

    def search(self, q: np.ndarray, n: int) -> list[int]:
        """The n most promising leaves for q, in order."""
        margin = self.normal @ q - self.offset
        inner = (1 << self.depth) - 1
        queue = [(-math.inf, t, 0) for t in range(self.trees)]
        out: list[int] = []
        while queue and len(out) < n:
            bound, t, node = heapq.heappop(queue)
            if node >= inner:
                out.append((t << self.depth) + node - inner)
                continue
            m = float(margin[t, node])
            heapq.heappush(queue, (max(bound, -m), t, 2 * node + 2))
            heapq.heappush(queue, (max(bound, m), t, 2 * node + 1))
        return out


def lifted(x: np.ndarray, largest: float) -> np.ndarray:
    """Vectors with the component that makes their norms equal."""
    more = np.sqrt(np.maximum(0.0, largest ** 2 - (x * x).sum(axis=1)))
    return np.concatenate([x, more[:, None]], axis=1).astype(np.float32)


def tuned_leaves(forest: Forest, sample: np.ndarray, largest: float, k: int, recall: float,
                 queries: int = 200) -> int:
    """Smallest number of leaves that reaches ``recall`` on the sample, with
    sampled queries against all sampled vectors."""
    total = forest.trees << forest.depth
    if forest.depth == 0:
        return total
    at = np.linspace(0, len(sample) - 1, min(queries, len(sample))).astype(int)
    score = sample[at] @ sample.T
    score[np.arange(len(at)), at] = -np.inf
    k = min(k, len(sample) - 1)
    near = np.argpartition(-score, k - 1, axis=1)[:, :k]
    leaf = forest.leaves(lifted(sample, largest))
    need = []
    for row, q in zip(near, sample[at]):
        place = np.full(total, total)
        order = forest.search(np.append(q, 0).astype(np.float32), total)
        place[order] = np.arange(len(order))
        need += (place[leaf[row]].min(axis=1) + 1).tolist()
    return int(min(total, max(forest.trees, np.ceil(np.quantile(need, recall)))))


#: Pairs whose exact scores are computed at once.
PAIRS = 1 << 16


def _rerank(d: int, k: int):
    """The k best ids of a block of vectors for each query of a block, as far as they
    reach the query's ``floor``."""

    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        x, ids = matrix(vectors["v"], d), vectors["vec_id"].to_numpy()
        q, names = matrix(queries["v"], d), queries["query_id"].to_numpy()
        floor = queries["floor"].to_numpy()
        order = np.argsort(ids, kind="stable")  # rows of one id side by side
        x, ids = x[order], ids[order]
        first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        size = np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1).max())
        out = []
        for at in range(0, len(q), 256):
            score = q[at:at + 256] @ x.T
            own = names[at:at + 256, None] == ids[None, :]
            score[own] = -np.inf
            # an id counts once, with its best row
            best = np.maximum.reduceat(score, first, axis=1) if len(first) < len(ids) else score
            edge = np.partition(best, -k, axis=1)[:, -k] if best.shape[1] > k else np.full(len(best), -np.inf)
            edge = np.fmax(edge, floor[at:at + 256])  # a null floor counts for nothing
            edge = edge - 1e-9 * (1 + np.abs(edge)) - 1e-12 * size[at:at + 256]  # rounding is far below this
            i, j = np.nonzero((score >= edge[:, None]) & ~own)
            # the product of two rows, summed in one order wherever the pair meets
            exact = np.concatenate([np.einsum("ij,ij->i", q[at + i[s:s + PAIRS]], x[j[s:s + PAIRS]])
                                    for s in range(0, len(i), PAIRS)] or [np.zeros(0)])
            best = best_pairs(i, ids[j], exact, k)
            out.append(pd.DataFrame({"query_id": names[at + i[best]], "vec_id": ids[j[best]], "score": exact[best]}))
        return pd.concat(out)

    return run


def leaf_candidates(index: DataFrame, probes: DataFrame, d: int, k: int) -> DataFrame:
    """query_id, vec_id, score: the best k of each block that a query meets in its
    ``leaves``.  ``index``: vec_id, v, leaves; ``probes``: these and floor.  A leaf
    with many vectors or queries is dealt to blocks of bounded size."""
    leaf = lambda t: t.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count()
    # a row for each leaf of the forest: bounded by the forest
    cells = leaf(index).withColumn("vector_blocks", F.ceil(F.col("count") / BLOCK).cast("int")).drop("count").join(
        leaf(probes).withColumn("query_blocks", F.ceil(F.col("count") / BLOCK).cast("int")).drop("count"), "leaf")
    cells = F.broadcast(common.cut(cells, "cells"))
    spread = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.col(n)).cast("int")
    vectors = (index.select("vec_id", "v", F.explode("leaves").alias("leaf")).join(cells, "leaf")
               .select("leaf", deal("vector_blocks").alias("vb"), F.explode(spread("query_blocks")).alias("qb"),
                       "vec_id", "v"))
    queries = (probes.select("vec_id", "v", "floor", F.explode("leaves").alias("leaf")).join(cells, "leaf")
               .select("leaf", F.explode(spread("vector_blocks")).alias("vb"), deal("query_blocks").alias("qb"),
                       F.col("vec_id").alias("query_id"), "v", "floor"))
    block = ["leaf", "vb", "qb"]
    return vectors.groupBy(*block).cogroup(queries.groupBy(*block)).applyInPandas(
        _rerank(d, k), "query_id long, vec_id long, score double")


def forest_search(df: DataFrame, is_query, k: int = 20, recall: float = 0.96, trees: int = 6,
                  leaf_rows: int = 2048, sample: int = 20_000, id_col: str = "vec_id",
                  vector_col: str = "embedding") -> DataFrame:
    """The k rows found nearest (largest inner product) for each query row.

    ``is_query``: column condition on vec_id.  Columns: query_id, rank, vec_id,
    score.  The trees are fitted on at most ``sample`` rows, the leaves aimed at
    ``recall``; every valid row is indexed.  Rows that take no part are those of
    ``vectors.valid_vectors``; a row never finds rows with its own id; equal rows
    are one row, and rows with one id count once in a result.  Without valid rows the result is empty.
    """
    spark = df.sparkSession
    common.ship(spark)
    rows, d, n = valid_vectors(df, id_col, vector_col, zero=False)
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = common.cut(rows.distinct(), "rows")
    n = rows.count()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    largest = float(rows.agg(F.max(norm)).head()[0])
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).select("v").collect()
    points = np.array([r.v for r in picked])
    depth = max(0, min(round(math.log2(max(1.0, n / leaf_rows))), int(math.log2(max(1, len(points) // 16)))))
    trees = trees if depth else 1
    forest = Forest(lifted(points, largest), trees, depth)
    take = tuned_leaves(forest, points, largest, k, recall)
    shared = spark.sparkContext.broadcast(forest)  # its size is set by sample, trees and depth

    def route(batches):
        for b in batches:
            leaf = shared.value.leaves(lifted(matrix(b.column("v"), d), largest))
            at = pa.array(np.arange(0, leaf.size + 1, leaf.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("v"), pa.ListArray.from_arrays(at, pa.array(leaf.ravel()))],
                names=["vec_id", "v", "leaves"])

    def probe(batches):
        for b in batches:
            x = matrix(b.column("v"), d)
            found = [shared.value.search(np.append(q, 0).astype(np.float32), take) for q in x]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("v"), pa.array(found, type=pa.list_(pa.int32()))],
                names=["vec_id", "v", "leaves"])

    ddl = "vec_id long, v array<double>, leaves array<int>"
    index = common.cut(rows.mapInArrow(route, ddl), "index")
    probes = common.cut(rows.where(is_query).mapInArrow(probe, ddl), "probes")
    # the most promising leaves give each query a floor, its k-th best score there;
    # of the further leaves only what reaches it leaves a task, however many they are
    first = probes.withColumns({"leaves": F.slice("leaves", 1, trees), "floor": F.lit(None).cast("double")})
    found = common.cut(leaf_candidates(index, first, d, k), "near")
    if take > trees:
        floor = ranked(found, k).where(F.col("rank") == k).select(
            F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
        further = common.cut(probes.withColumn("leaves", F.slice("leaves", trees + 1, take))
                             .join(floor, "vec_id", "left"), "further")
        found = found.unionByName(leaf_candidates(index, further, d, k))
    return ranked(found, k)
