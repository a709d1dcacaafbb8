"""Exact top-k search with multi-resolution segment statistics.

A vector is cut into segments; of each its mean and deviation are kept, for
coarse segments first and ever finer ones after.  For two vectors with segment
means m, m' and deviations s, s' over segments of w components,

    <q, x>  <=  sum w (m m' + s s')

which is the lower bound of their distance, |q - x|^2 >= sum w ((m - m')^2 +
(s - s')^2), read as a bound of the inner product.  A candidate whose bound is
below a query's k-th best score so far is dropped at the coarsest level that
shows it; scores of the survivors are computed exactly (as one matrix product where
they are many: picking their vectors one by one costs more than that).

Queries and candidates are dealt to a grid of blocks, each pair of a query
block and a candidate block is one task's work, and the k best of each are
merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .vectors import best_pairs, matrix, ranked, valid_vectors

LONG = (1 << 63) - 1
#: Segments at each level, coarse to fine.
LEVELS = (2, 4, 8, 16)
#: If more than one pair in so many survives the bounds, a chunk's scores are one matrix product.
DENSE = 50


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each row's segments, scaled so that the product
    of two rows is the bound."""
    parts = np.array_split(np.arange(x.shape[1]), min(segments, x.shape[1]))
    out = []
    for p in parts:
        w = np.sqrt(len(p))
        out += [w * x[:, p].mean(axis=1), w * x[:, p].std(axis=1)]
    return np.stack(out, axis=1)


def exact_in_doubles(q: np.ndarray, x: np.ndarray) -> bool:
    """Whether every sum of products of the rows' whole numbers is exact in doubles, in any order."""
    return float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1] < 2.0 ** 53


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of paired rows (whole numbers held as doubles);
    beyond the range of a long they saturate."""
    if not len(q):
        return np.zeros(0, np.int64)
    if exact_in_doubles(q, x):
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    total = [sum(int(a) * int(b) for a, b in zip(r, s)) for r, s in zip(q, x)]
    return np.array([max(-LONG - 1, min(LONG, t)) for t in total], np.int64)


def _block(d: int, k: int, chunk: int = 512):
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        kinds = {"query_id": "int64", "vec_id": "int64", "score": "int64"}
        if not len(vectors) or not len(queries):
            return pd.DataFrame({c: [] for c in kinds}).astype(kinds)
        vectors = vectors.sort_values("vec_id", kind="stable")
        x, ids = np.floor(256 * matrix(vectors["v"], d)), vectors["vec_id"].to_numpy()
        q, names = np.floor(256 * matrix(queries["v"], d)), queries["query_id"].to_numpy()
        levels = [n for n in LEVELS if n < d]
        of_q = [segment_features(q, n) for n in levels]
        of_x = [segment_features(x, n) for n in levels]
        size = np.linalg.norm(q, axis=1)
        whole = exact_in_doubles(q, x)
        edge = np.full(len(q), -np.inf)  # each query's k-th best score so far
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        for at in range(0, len(x), chunk):
            part = slice(at, at + chunk)
            open_ = names[:, None] != ids[None, part]
            # rounding of the bound is far below this
            slack = 1e-9 * (1 + size[:, None] * np.linalg.norm(x[part], axis=1)[None, :])
            for fq, fx in zip(of_q, of_x):
                if not np.isfinite(edge).any():
                    break
                open_ &= fq @ fx[part].T + slack >= edge[:, None]
            if whole and DENSE * np.count_nonzero(open_) > open_.size:
                scores = q @ x[part].T
                i, j = np.nonzero(open_ & (scores >= edge[:, None]))
                score = scores[i, j].astype(np.int64)
            else:
                i, j = np.nonzero(open_)
                score = np.concatenate([exact_scores(q[i[s:s + 200_000]], x[at + j[s:s + 200_000]])
                                        for s in range(0, len(i), 200_000)] or [np.zeros(0, np.int64)])
            good = score >= edge[i]
            merged = [np.concatenate(p) for p in zip(best, (i[good], ids[at + j[good]], score[good]))]
            top = best_pairs(merged[0], merged[1], merged[2], k)
            best = tuple(p[top] for p in merged)
            n = np.bincount(best[0], minlength=len(q))
            full = np.full(len(q), np.inf)
            np.minimum.at(full, best[0], best[2].astype(float))
            edge = np.where(n >= k, full, -np.inf)
        return pd.DataFrame({"query_id": names[best[0]], "vec_id": best[1], "score": best[2]}).astype(kinds)

    return run


def exact_top_k(df: DataFrame, is_query, k: int = 5, vector_block: int = 8192, query_block: int = 2048,
                id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each query row the k rows with the largest inner product of
    floor(256 x), ties to the smaller vec_id: query_id, rank, vec_id, score.

    ``is_query``: column condition on vec_id.  Rows that take no part are those
    of ``vectors.valid_vectors`` (zero vectors do take part); a row is never
    matched with rows of its own id; rows with one id count once in a result,
    with the best of their scores.  Without valid rows the result is empty.
    """
    spark = df.sparkSession
    common.ship(spark)
    rows, d, n = valid_vectors(df, id_col, vector_col, zero=True)
    n_queries = rows.where(is_query).count() if n else 0
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    vb, qb = -(-n // vector_block), -(-n_queries // query_block)
    spread = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    deal = lambda m: F.pmod(F.xxhash64("vec_id", "v"), F.lit(m)).cast("int")
    vectors = rows.select(deal(vb).alias("vb"), spread(qb).alias("qb"), "vec_id", "v")
    queries = rows.where(is_query).select(spread(vb).alias("vb"), deal(qb).alias("qb"),
                                          F.col("vec_id").alias("query_id"), "v")
    found = vectors.groupBy("vb", "qb").cogroup(queries.groupBy("vb", "qb")).applyInPandas(
        _block(d, k), "query_id long, vec_id long, score long")
    return ranked(found, k)
