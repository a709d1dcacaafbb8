import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paylake.llm import rp_forest, topk_search
from paylake.llm.vectors import best_pairs


@pytest.fixture(scope="module")
def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0, 0.5]), (1, [1.0, 2.0, 0.5]), (2, None), (3, [1.0, None, 2.0]), (4, [nan, 1.0, 1.0]),
            (5, [inf, 1.0, 1.0]), (6, [0.0, 0.0, 0.0]), (7, [-1.0, 0.1, 0.2]), (8, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]),
            (20, [0.3, 0.2, 0.1]), (20, [0.3, 0.2, 0.1]), (50, [0.5, -0.5, 0.25]), (100, [2.0, 1.0, 0.0]), (9, [])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def brute(rows, every, k, whole):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 3
            and all(x is not None and math.isfinite(x) for x in v) and (whole or any(v))]
    if whole:
        rows = [(i, np.floor(256 * v)) for i, v in rows]
    out = set()
    for q, x in rows:
        if q % every == 0:
            best = {}
            for i, y in rows:
                if i != q:
                    best[i] = max(best.get(i, -math.inf), float(x @ y))
            for n, (i, s) in enumerate(sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k], 1):
                out.add((q, n, i, round(s, 9)))
    return out


def rows_of(df):
    return {(r.query_id, r.rank, r.vec_id, round(float(r.score), 9)) for r in df.collect()}


def test_odd_vectors(odd_vectors, clash):
    data = [(r.vec_id, r.embedding) for r in odd_vectors.collect()]
    got = topk_search.exact_top_k(clash.add(odd_vectors), F.col("vec_id") % 50 == 0)
    assert rows_of(got) == brute(data, 50, 5, True)
    got = rp_forest.forest_search(clash.add(odd_vectors), F.col("vec_id") % 20 == 0)
    assert rows_of(got) == brute(data, 20, 20, False)


def test_empty(odd_vectors):
    none = odd_vectors.limit(0)
    assert topk_search.exact_top_k(none, F.col("vec_id") % 50 == 0).count() == 0
    assert rp_forest.forest_search(none, F.col("vec_id") % 20 == 0).count() == 0
    no_query = odd_vectors.where("vec_id = 7")
    assert topk_search.exact_top_k(no_query, F.col("vec_id") % 50 == 0).count() == 0
    assert rp_forest.forest_search(no_query, F.col("vec_id") % 20 == 0).count() == 0


def test_exact_search_equals_brute_force(read):
    e = read("embeddings")
    ids = np.array([r.vec_id for r in e.collect()])
    x = np.floor(256 * np.array([r.embedding for r in e.collect()], float)).astype(np.int64)
    want = set()
    for q in np.flatnonzero(ids % 50 == 0):
        s = x @ x[q]
        order = [k for k in np.lexsort((ids, -s)) if ids[k] != ids[q]][:5]
        want |= {(int(ids[q]), n, int(ids[k]), float(s[k])) for n, k in enumerate(order, 1)}
    # small blocks, so that blocks are merged
    assert rows_of(topk_search.exact_top_k(e, F.col("vec_id") % 50 == 0, vector_block=60, query_block=3)) == want


def test_bounds_hold():
    rng = np.random.default_rng(1)
    q, x = rng.integers(-256, 256, (20, 64)).astype(float), rng.integers(-256, 256, (50, 64)).astype(float)
    last = None
    for n in topk_search.LEVELS:
        bound = topk_search.segment_features(q, n) @ topk_search.segment_features(x, n).T
        assert (bound >= q @ x.T - 1e-6).all()
        assert last is None or (bound <= last + 1e-6).all()  # finer levels are tighter
        last = bound


def test_forest_recall(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((6000, 24))
    x[:700] = x[0]  # one vector a ninth of all rows
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in rp_forest.forest_search(df, F.col("vec_id") % 20 == 0, leaf_rows=256).collect():
        got.setdefault(r.query_id, set()).add(r.score)
        assert abs(r.score - x[r.query_id] @ x[r.vec_id]) < 1e-9
    hits = total = 0
    for q in range(0, 6000, 20):
        s = np.delete(x @ x[q], q)
        edge = np.sort(s)[-20] - 1e-9
        hits += 20 if len(got[q]) < 20 and min(got[q]) >= edge else sum(v >= edge for v in got[q])
        total += 20
    assert hits / total >= 0.9


def test_best_pairs_counts_an_id_once():
    q, i, s = np.array([0, 0, 0, 1]), np.array([5, 5, 3, 9]), np.array([2.0, 2.0, 2.0, 1.0])
    assert [(q[k], i[k]) for k in best_pairs(q, i, s, 2)] == [(0, 3), (0, 5), (1, 9)]


def test_floor_leaves_out_only_what_lies_below_it():
    rng = np.random.default_rng(3)
    x, q = rng.standard_normal((300, 8)), rng.standard_normal((5, 8))
    x[200:] = x[0]  # ties
    vectors = pd.DataFrame({"vec_id": np.arange(300), "v": list(x)})
    queries = pd.DataFrame({"query_id": np.arange(1000, 1005), "v": list(q), "floor": np.nan})
    whole = rp_forest._rerank(8, 20)(vectors, queries)
    floor = whole.groupby("query_id")["score"].nth(9).to_numpy()
    floor[0] = np.nan  # a query without a floor
    some = rp_forest._rerank(8, 20)(vectors, queries.assign(floor=floor))
    edge = np.where(np.isnan(floor), -np.inf, floor)[whole["query_id"].to_numpy() - 1000]
    want = whole[whole["score"].to_numpy() >= edge]
    assert set(map(tuple, some.to_numpy())) == set(map(tuple, want.to_numpy()))
    assert len(some) < len(whole)


def test_repeated_ids_and_copies_at_the_edge():
    rng = np.random.default_rng(4)
    x, q = rng.standard_normal((3001, 128)), rng.standard_normal((256, 128))
    x[1500:] = x[rng.integers(0, 1500, 1501)]  # copies, so that many edges fall on them
    ids = np.arange(3001)
    ids[:100] = 0  # one id a hundred times
    x[:100] = q[:1] * 5
    found = rp_forest._rerank(128, 20)(pd.DataFrame({"vec_id": ids, "v": list(x)}), pd.DataFrame(
        {"query_id": np.arange(10_000, 10_256), "v": list(q), "floor": np.nan}))
    got = {n: list(g.sort_values(["score", "vec_id"], ascending=[False, True])["vec_id"])
           for n, g in found.groupby("query_id")}
    for k in range(256):
        exact = np.einsum("ij,ij->i", np.repeat(q[k:k + 1], 3001, axis=0), x)
        best = {}
        for i, v in zip(ids, exact):
            best[i] = max(best.get(i, -math.inf), v)
        assert got[10_000 + k] == [i for i, _ in sorted(best.items(), key=lambda p: (-p[1], p[0]))[:20]]


def test_a_repeated_row_leaves_room_for_others(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((60, 8))
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(1, (x[0] * 9).tolist())] * 100
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank, r.vec_id) for r in rp_forest.forest_search(df, F.col("vec_id") % 20 == 0).collect()}
    want = set()
    for q in range(0, 60, 20):
        best = {}
        for i, v in data:
            if i != q:
                best[i] = max(best.get(i, -math.inf), float(x[q] @ np.array(v)))
        want |= {(q, n, i) for n, (i, _) in enumerate(sorted(best.items(), key=lambda p: (-p[1], p[0]))[:20], 1)}
    assert got == want


def test_many_surviving_pairs_are_scored_by_one_product(monkeypatch):
    """Random vectors, of which the bounds drop few: no pair's vectors are picked one by one."""
    rng = np.random.default_rng(5)
    rows = pd.DataFrame({"vec_id": np.arange(3000), "v": list(rng.normal(size=(3000, 64)))})
    queries = rows[rows["vec_id"] % 50 == 0].rename(columns={"vec_id": "query_id"})
    picked = []
    real = topk_search.exact_scores
    monkeypatch.setattr(topk_search, "exact_scores", lambda q, x: (picked.append(len(q)), real(q, x))[1])
    got = topk_search._block(64, 5)(rows, queries)
    assert sum(picked) < 60 * 3000 / 50
    x = np.floor(256 * np.stack(rows["v"])).astype(np.int64)
    for q, best in got.groupby("query_id"):
        want = sorted(((-int(s), i) for i, s in enumerate(x @ x[q]) if i != q))[:5]
        assert sorted(zip((-best["score"]).tolist(), best["vec_id"].tolist())) == want
