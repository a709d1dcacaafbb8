"""Plan checks: the physical plans are the ones we want at scale."""

import pytest

from conftest import SF_SMALL
from paylake.operators import dedup, joins, kpis, marts
from paylake.plans.catalog import QUERIES, Marts
from paylake.sources import tables as fx
from paylake.sources.files import read_mart
from paylake.sinks.parquet import write_partitioned

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas",
                "FlatMapGroupsInPandas", "MapInArrow", "PythonMapInArrow")
# keys whose callables write files first (checked elsewhere)
WRITERS = {"src_csv_scan", "src_multi_file_union", "src_mart_year_scan", "src_list_files",
           "snk_partitioned_roundtrip", "snk_idempotent_append", "val_missing_columns",
           "stream_ingest_once", "stream_dedup", "stream_watermark", "stream_marts"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - WRITERS))
def test_no_python_in_plans(spark, key):
    p = plan(QUERIES[key](spark, SF_SMALL))
    assert not any(n in p for n in PYTHON_NODES), key


def test_dedup_aggregates_map_side(spark):
    p = plan(fx.transactions(spark, SF_SMALL))
    assert "partial_min" in p            # duplicates collapse before the shuffle
    assert "Window" not in p


def test_top_k_without_full_sort(spark):
    p = plan(kpis.top_refund_merchants(Marts(spark, SF_SMALL).refund))
    assert "TakeOrderedAndProject" in p


def test_kpi_filter_pushed_to_written_mart_and_partitions_pruned(spark, tmp_path):
    m = Marts(spark, SF_SMALL).transaction
    out = str(tmp_path / "mart")
    write_partitioned(m, out, marts.PARTITION_COLUMNS["transaction_performance"])
    df = read_mart(spark, out, "transaction_performance", year=1995)
    p = plan(kpis.channel_revenue(df))
    assert "PartitionFilters: [isnotnull(transaction_year" in p and "= 1995" in p
    assert "PushedFilters: [IsNotNull(transaction_status), EqualTo(transaction_status,SUCCESS)]" in p
    # only the columns the KPI needs are read
    schema = p.split("ReadSchema: ")[1].split("\n")[0]
    assert "merchant_name" not in schema and "processing_fee" in schema


def test_broadcast_only_with_known_bounded_count(spark):
    t = fx.transactions_clean(fx.transactions(spark, SF_SMALL))
    m = dedup.latest_by_key(fx.merchants(spark, SF_SMALL), "merchant_id")
    c = dedup.latest_by_key(fx.channels(spark, SF_SMALL), "channel_id")
    hinted = marts.transaction_performance(t, m, c, dim_rows={"merchant": 10, "channel": 4})
    lp = hinted._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in lp.lower()
    too_big = marts.transaction_performance(t, m, c, dim_rows={"merchant": 10**9, "channel": 10**9})
    lp2 = too_big._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in lp2.lower()
    assert joins.maybe_broadcast(m, None) is m


def test_settlement_lookup_reuses_dedup_partitioning(spark):
    df = Marts(spark, SF_SMALL).settlement
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    # the deduplicated transactions are computed once and shared
    assert final.count("lineitem.parquet") == 1
    assert "ReusedExchange" in final


def test_single_pass_transaction_kpis_equal_direct(spark):
    m = Marts(spark, SF_SMALL).transaction
    direct = kpis.transaction_kpis(m)
    via = kpis.transaction_kpis_from_summary(kpis.transaction_summary(m))
    assert direct.keys() == via.keys()
    for k in direct:
        assert direct[k].columns == via[k].columns, k
        assert direct[k].collect() == via[k].collect(), k     # same rows, same order


def test_single_pass_settlement_kpis_equal_direct(spark):
    m = Marts(spark, SF_SMALL).settlement
    direct = kpis.settlement_kpis(m)
    via = kpis.settlement_kpis_from_summary(kpis.settlement_summary(m))
    assert direct.keys() == via.keys()
    for k in direct:
        assert direct[k].columns == via[k].columns, k
        assert direct[k].collect() == via[k].collect(), k
