"""Vectors in and out of Arrow batches, shared by the two vector searches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def valid_vectors(df: DataFrame, id_col: str, vector_col: str, zero: bool) -> tuple[DataFrame, int, int]:
    """vec_id, v (array of double) of the rows that take part, their dimension
    and number.  Left out: null ids, null vectors, vectors that hold a null or a
    non-finite component, zero vectors unless ``zero``, and vectors that do not
    have the commonest dimension (the larger one in a tie)."""
    v = F.col("v")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"),
                     F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    if not zero:
        rows = rows.where(F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    if sizes is None:
        return rows, 0, 0
    return rows.where(F.size(v) == sizes["d"]), sizes["d"], sizes["count"]


def matrix(column, d: int) -> np.ndarray:
    """Rows of an Arrow list column or of a pandas column of arrays."""
    if hasattr(column, "flatten"):
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, d))


def best_pairs(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best pairs of each query: larger score, then smaller id;
    an id counts once a query."""
    order = np.lexsort((ids, -score, query))
    q, i = query[order], ids[order]
    pair = np.lexsort((np.arange(len(q)), i, q))
    first = np.ones(len(q), bool)
    first[1:] = (q[pair][1:] != q[pair][:-1]) | (i[pair][1:] != i[pair][:-1])
    keep = np.zeros(len(q), bool)
    keep[pair[first]] = True
    order, q = order[keep], q[keep]
    if not len(q):
        return order
    start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
    return order[rank < k]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score from partial results."""
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
