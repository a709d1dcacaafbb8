"""Join helpers and size profiling."""

from paylake.operators import joins, profile


def test_left_lookup_null_bypass_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (None, "d"), (3, "e")],
                                 "k int, v string")
    right = spark.createDataFrame([(1, "x"), (2, "y")], "rk int, w string")
    plain = {tuple(r) for r in joins.left_lookup(left, right, "k", "rk").collect()}
    bypass = {tuple(r) for r in joins.left_lookup(left, right, "k", "rk", bypass_nulls=True).collect()}
    assert plain == bypass == {(1, "a", "x"), (None, "b", None), (2, "c", "y"),
                               (None, "d", None), (3, "e", None)}


def test_left_lookup_rejects_clashing_columns(spark):
    import pytest
    a = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError):
        joins.left_lookup(a, a.withColumnRenamed("k", "rk"), "k", "rk")


def _hinted(df) -> bool:
    return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()


def test_maybe_broadcast_needs_rows_and_bytes_within_bounds(spark):
    dim = spark.createDataFrame([(1, "x")], "k int, v string")
    assert _hinted(joins.maybe_broadcast(dim, 10))
    assert _hinted(joins.maybe_broadcast(dim, (10, 1000)))
    assert not _hinted(joins.maybe_broadcast(dim, (10, 10**12)))
    assert not _hinted(joins.maybe_broadcast(dim, 10**9))
    assert not _hinted(joins.maybe_broadcast(dim, None))


def test_dataset_sizes_measures_rows_and_payload(spark):
    a = spark.createDataFrame([(1, "abc"), (2, None)], "k int, v string")
    b = spark.createDataFrame([], "k long")
    out = {r.dataset: (r.record_count, r.payload_bytes)
           for r in profile.dataset_sizes({"a": a, "b": b}).collect()}
    assert out == {"a": (2, 4 + 3 + 4 + 0), "b": (0, 0)}
    assert {r.dataset: r.record_count for r in profile.dataset_counts({"a": a}).collect()} == {"a": 2}


def test_configured_broadcast_limits_reach_the_marts(spark):
    from paylake import schemas as S
    from paylake.operators import marts
    frames = {n: spark.createDataFrame([], S.BY_NAME[n].schema) for n in ("transactions", "merchant", "channel")}
    known = {"merchant": (3_000_000, 10), "channel": (3_000_000, 10)}
    hinted = []
    for limits in ((2_000_000, 1 << 28), (4_000_000, 1 << 28)):
        df = marts.transaction_performance(*frames.values(), dim_rows=known, limits=limits)
        hinted.append("ResolvedHint" in df._jdf.queryExecution().analyzed().toString())
    assert hinted == [False, True]


def test_decimal_digits_are_checked(spark):
    from paylake.operators import quality
    rows = spark.createDataFrame([("S1", "1.50", "0.10"), ("S2", "1.505", "99999999999"), ("S3", None, "3")],
                                 "settlement_id string, gross_amount string, fee_amount string").selectExpr(
        "settlement_id", "cast(null as int) merchant_id", "'T' transaction_id", "date'2026-01-01' settlement_date",
        "cast(gross_amount as decimal(20,4)) gross_amount", "cast(fee_amount as decimal(20,4)) fee_amount",
        "cast(0 as decimal(12,2)) net_amount", "'SETTLED' settlement_status")
    got = {(r.column_name, r.rule): r.violations for r in quality.domain_violations({"settlements": rows}).collect()}
    assert got["gross_amount", "decimal_12_2"] == 1 and got["fee_amount", "decimal_12_2"] == 1
    assert got["net_amount", "decimal_12_2"] == 0
