import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paylake.llm import hard_negatives as H
from paylake.llm.queries import NEGATIVES_SQL, op12_hard_negatives


def brute(rows, every=50, dim=None, k=5, m=3, low=50, high=95):
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or len(v) != dim or any(
                x is None or not math.isfinite(x) for x in v):
            continue
        kept[i] = min(kept.get(i, (label, tuple(v))), (label, tuple(v)))
    data = [(i, label, [math.floor(256 * x) for x in v]) for i, (label, v) in kept.items()]
    out = set()
    for a, label, q in data:
        if a % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, v)), i, c) for i, c, v in data if i != a))
        for s, p, _ in [r for r in scored if r[2] == label][:k]:
            found = [(n, i) for n, i, c in scored if c != label and low * -s <= 100 * -n <= high * -s][:m]
            out |= {(a, p, r, i, -s, -n) for r, (n, i) in enumerate(found, 1)}
    return out


def rows_of(df):
    return {tuple(r) for r in df.collect()}


def test_equals_brute_force(spark, read):
    e = read("embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    data = [(r.vec_id, r.label, r.embedding) for r in e.withColumn("label", label).collect()]
    want = brute(data, dim=64)
    assert want and rows_of(op12_hard_negatives(spark, "/root/testdata/sf0.001")) == want
    small = H.hard_negatives(e.withColumn("label", label), F.col("vec_id") % 50 == 0, row_block=7, anchor_block=2)
    assert rows_of(small) == want  # blocks are merged
    db = duckdb.connect()
    db.execute("create view embeddings as select * from '/root/testdata/sf0.001/embeddings.parquet'")
    assert set(db.execute(NEGATIVES_SQL).fetchall()) == want


def test_hot_label_ties_and_odd_rows(spark, clash):
    rng = np.random.default_rng(6)
    x = np.round(rng.standard_normal((400, 6)) * 2) / 8  # many equal scores
    rows = [(i, 0 if i % 3 else int(rng.integers(4)), v.tolist()) for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    rows += [(1000, None, x[0].tolist()), (1050, 1, None), (1100, 1, [nan] * 6), (1150, 1, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
             (None, 1, x[1].tolist()), (1200, 2, [0.0] * 6), (1250, 2, [1.0, 2.0]), (1300, 3, []), (1350, 9, [inf] * 6),
             (50, 3, x[3].tolist()), (51, 0, x[51].tolist()), (1400, 77, x[9].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    for few in (4, 8192):
        got = H.hard_negatives(clash_label(clash, df), F.col("vec_id") % 10 == 0, row_block=few, anchor_block=few)
        assert rows_of(got) == brute(rows, 10, 6)
    wide = H.hard_negatives(df, F.col("vec_id") % 10 == 0, positives=2, negatives=7, low=-30, high=100)
    assert rows_of(wide) == brute(rows, 10, 6, 2, 7, -30, 100)


def clash_label(clash, df):
    return clash.add(df.withColumn("b", F.lit("x")).withColumn("positives", F.lit(1)))


def test_empty(spark):
    df = spark.createDataFrame([(7, 1, [1.0]), (8, 1, [2.0])], "vec_id long, label int, embedding array<double>")
    assert H.hard_negatives(df, F.col("vec_id") % 50 == 0).count() == 0
    assert H.hard_negatives(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert H.hard_negatives(df, F.col("vec_id") == 7).count() == 0  # a positive, no negative


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2 ** 31), st.integers(1, 40), st.integers(1, 30))
def test_scan_keeps_what_matters(seed, n, d):
    rng = np.random.default_rng(seed)
    x, q = rng.integers(-40, 40, (n, d)).astype(float), rng.integers(-40, 40, d).astype(float)
    score = (x @ q).astype(int)
    shown = []

    def watch(shrink):
        def run(low, high):
            shown.append(len(low))
            return shrink(low, high)
        return run

    at, got = H.Columns(x).scan(q, np.ones(n, bool), watch(H.top_rows(3)))
    assert (got == score[at]).all() and sorted(got)[-3:] == sorted(score)[-3:]
    assert shown == sorted(shown, reverse=True)
    windows = np.sort(rng.integers(-4000, 4000, (3, 2)), axis=1)
    at, got = H.Columns(x).scan(q, np.arange(n) % 2 == 0, H.window_rows(windows, 2))
    assert (got == score[at]).all()
    for a, z in windows:
        want = sorted(s for k, s in enumerate(score) if k % 2 == 0 and a <= s <= z)[-2:]
        assert sorted(s for s in got if a <= s <= z)[-2:] == want


def test_bitmap_shrinks_before_the_last_column():
    rng = np.random.default_rng(8)
    x = rng.integers(-10, 10, (5000, 64)).astype(float)
    q = np.floor(2000 * 0.8 ** np.arange(64))  # few columns carry the score
    seen = []

    def shrink(low, high):
        seen.append(len(low))
        return H.top_rows(5)(low, high)

    H.Columns(x).scan(q, np.ones(5000, bool), shrink)
    assert seen[0] == 5000 and seen[2] < 500


@settings(max_examples=500)
@given(st.integers(-10 ** 12, 10 ** 12), st.integers(-100, 100))
def test_share_is_exact(score, part):
    w = np.array([score])
    assert H.share(part, w, True)[0] == -((-part * score) // 100) and H.share(part, w, False)[0] == part * score // 100


def test_large_components(spark):
    rng = np.random.default_rng(9)
    rows = [(i, i % 2, (rng.standard_normal(8) * 1e6).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert rows_of(H.hard_negatives(df, F.col("vec_id") % 10 == 0)) == brute(rows, 10, 8)


@pytest.mark.parametrize("n", [1, 5])
def test_few_rows_of_a_label(spark, n):
    rows = [(i * 50, i // n, [1.0, i / 10]) for i in range(4 * n)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert rows_of(H.hard_negatives(df, F.col("vec_id") % 50 == 0)) == brute(rows, 50, 2)
