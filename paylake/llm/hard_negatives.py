"""Hard negatives by a vertical scan of columns (BOND).

For each anchor the rows of its own label with the largest scores are its
positives; rows of other labels whose score lies in a window below a positive's
score are its hard negatives.

Vertical scan.  A block of rows is held by columns.  An anchor reads the columns in
descending order of its own components' magnitude, some at a time, and adds their
products to each row's partial score.  What the columns not yet read can add lies
between sums of products with each column's smallest and largest component in the block, so
that a row's score lies in an interval.  A bitmap holds the rows whose interval can
still matter; it shrinks as the intervals do, and only rows in it read further
columns.  For positives a row leaves when its upper end is below the k-th largest
lower end.  For windows it leaves when its interval misses every window, or when a window's
places are taken by rows that surely lie in it and above.  Rows that stay to the end have
exact scores, which the windows then resolve.

Rows and anchors are dealt to a grid of blocks of bounded size; the positives' grid
is dealt for each label, by its numbers of rows and anchors, so that a label of any size is
spread over as many tasks as it needs.  Each task returns at most k rows for an anchor or window.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .topk_search import exact_scores
from .vectors import matrix, valid_vectors

#: Columns that an anchor reads between two looks at its bitmap.
STEP = 8


class Columns:
    """A block of rows by columns, with each column's range."""

    def __init__(self, x: np.ndarray):
        self.rows = x
        self.columns = np.ascontiguousarray(x.T)
        self.low, self.high = x.min(axis=0), x.max(axis=0)

    def scan(self, q: np.ndarray, open_: np.ndarray, shrink) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and exact scores of the rows that remain of ``open_``.  ``shrink``
        gets the ends of the rows' intervals and says which still matter."""
        order = np.argsort(-np.abs(q), kind="stable")
        least = np.minimum(q * self.low, q * self.high)[order]
        most = np.maximum(q * self.low, q * self.high)[order]
        # what is left to add after each column
        least = np.append(np.cumsum(least[::-1])[::-1], 0.0)
        most = np.append(np.cumsum(most[::-1])[::-1], 0.0)
        # sums of whole numbers below 2^53 are exact; beyond, rounding stays below this
        size = float(np.abs(q) @ np.maximum(np.abs(self.low), np.abs(self.high)))
        slack = 0.0 if size < 2.0 ** 52 else 1e-12 * size
        at = np.flatnonzero(open_)
        part = np.zeros(len(at))
        for s in range(0, len(q), STEP):
            if not len(at):
                break
            cols = order[s:s + STEP]
            every = len(at) == self.columns.shape[1]
            part = part + q[cols] @ (self.columns[cols] if every else self.columns[np.ix_(cols, at)])
            done = min(s + STEP, len(q))
            keep = shrink(part + least[done] - slack, part + most[done] + slack)
            if not keep.all():
                at, part = at[keep], part[keep]
        return at, exact_scores(np.broadcast_to(q, (len(at), len(q))), self.rows[at])


def top_rows(k: int):
    """Shrinks to the rows that can be among the k best."""
    def shrink(low, high):
        if len(low) <= k:
            return np.ones(len(low), bool)
        return high >= np.partition(low, len(low) - k)[len(low) - k]
    return shrink


def window_rows(windows: np.ndarray, k: int):
    """Shrinks to the rows that can be among the k best of one of the (lowest, highest)
    windows, ends included."""
    def shrink(low, high):
        keep = np.zeros(len(low), bool)
        for a, z in windows:
            floor = a
            inside = low[(low >= a) & (high <= z)]
            if len(inside) > k:
                floor = np.partition(inside, len(inside) - k)[len(inside) - k]
            keep |= (high >= floor) & (low <= z)
        return keep
    return shrink


def share(part: int, whole: np.ndarray, up: bool) -> np.ndarray:
    """``part`` percent of whole numbers, rounded up or down, without overflow."""
    hundreds, rest = np.divmod(whole, 100)
    return hundreds * part + (-((-rest * part) // 100) if up else (rest * part) // 100)


def _whole(column, d: int) -> np.ndarray:
    return np.floor(256 * matrix(column, d))


def _positives(d: int, k: int):
    kinds = {"anchor_id": "int64", "vec_id": "int64", "score": "int64"}

    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(anchors):
            ids, block = rows["vec_id"].to_numpy(), Columns(_whole(rows["v"], d))
            for name, q in zip(anchors["anchor_id"].to_numpy(), _whole(anchors["v"], d)):
                at, score = block.scan(q, ids != name, top_rows(k))
                best = np.lexsort((ids[at], -score))[:k]
                out.append(pd.DataFrame({"anchor_id": name, "vec_id": ids[at[best]], "score": score[best]}))
        return pd.concat(out).astype(kinds) if out else pd.DataFrame({c: [] for c in kinds}).astype(kinds)

    return run


def _negatives(d: int, k: int, low: int, high: int):
    kinds = {"anchor_id": "int64", "positive_id": "int64", "positive_score": "int64", "negative_id": "int64",
             "negative_score": "int64"}

    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(anchors):
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            block = Columns(_whole(rows["v"], d))
            for a, q in zip(anchors.itertuples(), _whole(anchors["v"], d)):
                names = np.array([p["vec_id"] for p in a.positives], np.int64)
                scores = np.array([p["score"] for p in a.positives], np.int64)
                ends = np.stack([share(low, scores, True), share(high, scores, False)], axis=1)
                useful = np.unique(ends[ends[:, 0] <= ends[:, 1]], axis=0)
                if not len(useful):
                    continue
                at, score = block.scan(q, labels != a.label, window_rows(useful, k))
                order = np.lexsort((ids[at], -score))
                at, score = ids[at[order]], score[order]
                for p, s, (least, most) in zip(names, scores, ends):
                    best = np.flatnonzero((score >= least) & (score <= most))[:k]
                    out.append(pd.DataFrame({"anchor_id": a.anchor_id, "positive_id": p, "positive_score": s,
                                             "negative_id": at[best], "negative_score": score[best]}))
        return pd.concat(out).astype(kinds) if out else pd.DataFrame({c: [] for c in kinds}).astype(kinds)

    return run


def hard_negatives(df: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   row_block: int = 8192, anchor_block: int = 512, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A row's score is the integer inner product of floor(256 x) with the anchor's; larger
    scores come first, ties go to the smaller vec_id.  An anchor's positives are its first
    ``positives`` other rows of its label.  For each, the first ``negatives`` rows of
    other labels with ``low`` * positive <= 100 * negative <= ``high`` * positive.

    ``is_anchor``: column condition on vec_id.  No part take rows without an id or a label
    and those that ``vectors.valid_vectors`` leaves out (zero vectors do take part); of
    rows that repeat an id the one with the smallest label, then vector, counts.  An anchor without
    positives, and a positive without negatives, has no rows in the result; a table
    without valid rows or anchors gives an empty result.  Labels are whole numbers below 2^53.
    """
    spark = df.sparkSession
    common.ship(spark)
    labelled = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"),
                         F.col(label_col).cast("long").alias("label")).where("label is not null")
    labels = F.struct("label", "v")
    # the label rides along as the vector's first component: valid_vectors reads two columns
    with_label = labelled.withColumn("_v", F.when(F.size("embedding") > 0, F.concat(
        F.array(F.col("label").cast("double")), F.col("embedding").cast("array<double>"))))
    valid, d, n = valid_vectors(with_label, "vec_id", "_v", zero=True)
    if n:
        valid = (valid.select("vec_id", F.col("v")[0].cast("long").alias("label"),
                              F.slice("v", 2, d - 1).alias("v"))
                 .groupBy("vec_id").agg(F.min(labels).alias("row")).select("vec_id", "row.label", "row.v"))
        valid = common.cut(valid, "labelled-vectors")
        n_rows, n_anchors = valid.count(), valid.where(is_anchor).count()
    if not n or not n_anchors:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    d -= 1
    spread = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), m - 1))
    again = lambda *names: [F.col(c).alias(c) for c in names]  # own columns for the other side
    deal = lambda m: F.pmod(F.xxhash64("vec_id"), m)
    blocks = lambda c, size: F.ceil(c / F.lit(size))

    # positives: a grid for each label
    of_label = (valid.groupBy("label").agg(blocks(F.count("*"), row_block).alias("rb"),
                                           blocks(F.count(F.when(is_anchor, 1)), anchor_block).alias("ab")))
    sized = valid.join(of_label.where("ab > 0"), "label")
    rows = sized.select("label", deal(F.col("rb")).alias("b"), spread(F.col("ab")).alias("c"), "vec_id", "v")
    anchors = sized.where(is_anchor).select(
        *again("label", "v"), spread(F.col("rb")).alias("b"), deal(F.col("ab")).alias("c"),
        F.col("vec_id").alias("anchor_id"))
    near = rows.groupBy("label", "b", "c").cogroup(anchors.groupBy("label", "b", "c")).applyInPandas(
        _positives(d, positives), "anchor_id long, vec_id long, score long")
    w = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    best = (near.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= positives)
            .groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives")))
    best = common.cut(best, "positives")  # at most ``positives`` entries an anchor

    # negatives: one grid
    rb, ab = F.lit(-(-n_rows // row_block)), F.lit(-(-n_anchors // anchor_block))
    rows = valid.select(deal(rb).alias("b"), spread(ab).alias("c"), "vec_id", "label", "v")
    anchors = (valid.where(is_anchor).withColumnRenamed("vec_id", "anchor_id").join(best, "anchor_id")
               .select(spread(rb).alias("b"), F.pmod(F.xxhash64("anchor_id"), ab).alias("c"), "anchor_id", "positives",
                       *again("label", "v")))
    far = rows.groupBy("b", "c").cogroup(anchors.groupBy("b", "c")).applyInPandas(
        _negatives(d, negatives, low, high),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    w = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (far.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                    "positive_score", "negative_score"))
