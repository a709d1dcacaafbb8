"""The batch job keeps on disk, and moves, no more than its work asks for."""

import glob
import time

import pytest
from pyspark.sql import functions as F

from conftest import write_text
from paylake.operators import dedup
from paylake.plans import batch
from paylake.plans.batch import BatchConfig, run_batch
from paylake.session import release_shuffles
from paylake.sinks.parquet import overwrite_partitions
from test_batch_job import CHANNEL, CUSTOMER, HEAD, MERCHANT, REFUND_LATE, TXN


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffles_of_finished_actions_are_released(spark, tmp_path):
    before = _shuffle_files(spark)
    spark.range(1000).groupBy(F.col("id") % 7).count().write.parquet(f"{tmp_path}/out")
    ours = _shuffle_files(spark) - before
    assert ours
    for _ in range(20):
        release_shuffles(spark)
        if not ours & _shuffle_files(spark):
            break
        time.sleep(0.5)
    assert not ours & _shuffle_files(spark)


def test_only_rows_of_repeated_keys_are_moved(spark, tmp_path):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "x"), ("c", 1, None), ("c", None, None), ("d", 3, "x")]
    spark.createDataFrame(rows, "k string, v int, w string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    dedup.repeated_keys(df, "k").write.parquet(f"{tmp_path}/r")
    repeated = spark.read.parquet(f"{tmp_path}/r")
    assert repeated.count() == 2  # a, c
    for descending in (False, True):
        want = dedup.latest_by_key(df, "k", ("v",), descending)
        got = dedup.latest_of_repeated(df, "k", repeated, ("v",), descending)
        assert got.schema == want.schema
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("broadcast_rows", [2_000_000, 0])
def test_keys_sent_twice_in_a_batch(spark, tmp_path, broadcast_rows):
    """The same rows whether or not the repeated keys may be broadcast; nothing stays staged."""
    cfg = BatchConfig(landing=f"{tmp_path}/landing", warehouse=f"{tmp_path}/wh", ledger=f"{tmp_path}/ledger",
                      max_broadcast_rows=broadcast_rows)
    for name, text in {"dim_customer_1": CUSTOMER, "dim_merchant_1": MERCHANT, "dim_payment_channel_1": CHANNEL}.items():
        write_text(f"{cfg.landing}/{name}.csv", text)

    def row(tid, status):
        return f"{tid},1,1,1,2026-01-01 10:00:00,100.00,{status},,MOBILE,HDFC,Pune,1.50\n"

    write_text(f"{cfg.landing}/fact_transactions_1.csv",
               HEAD + row("T1", "FAILED") + row("T1", "SUCCESS") + row("T2", "PENDING") + row("", "SUCCESS"))
    run_batch(spark, cfg)
    for table in ("base/transactions", "marts/transaction_performance"):
        got = spark.read.parquet(f"{cfg.warehouse}/{table}").select("transaction_id", "transaction_status").collect()
        assert sorted(map(tuple, got)) == [("T1", "SUCCESS"), ("T2", "PENDING")]
    assert spark.read.parquet(f"{cfg.warehouse}/quarantine/transactions").count() == 1
    staged = glob.glob(f"{cfg.warehouse}/staging/*/transactions")
    assert len(staged) == 1 and spark.read.parquet(staged[0]).count() == 0


def test_rows_that_are_not_late_stay_in_place(spark, tmp_path, monkeypatch):
    cfg = BatchConfig(landing=f"{tmp_path}/landing", warehouse=f"{tmp_path}/wh", ledger=f"{tmp_path}/ledger")
    head, first, second = MERCHANT.splitlines()
    for name, text in {"dim_merchant_1": f"{head}\n{first}\n", "dim_customer_1": CUSTOMER, "dim_payment_channel_1": CHANNEL,
                       "fact_transactions_1": TXN, "fact_refunds_1": REFUND_LATE + "R3,T3,1,2026-01-07 12:00:00,1.00,X,COMPLETED\n"}.items():
        write_text(f"{cfg.landing}/{name}.csv", text)
    run_batch(spark, cfg)
    # merchant 2 comes late; merchant 1 has another name by then, which holds for rows built later
    write_text(f"{cfg.landing}/dim_merchant_2.csv", f"{head}\n{first.replace('M1', 'NEW')}\n{second}\n")
    calls = {}
    monkeypatch.setattr(batch, "overwrite_partitions", lambda df, path, *a: (
        calls.update({path.split("/wh/")[1]: (df, *a)}), overwrite_partitions(df, path, *a)))
    run_batch(spark, cfg)
    moved, _, _, lying = calls["marts/transaction_performance"]
    assert moved is None and "Exchange hashpartitioning(transaction_id" not in lying._jdf.queryExecution().toString()
    *_, lying = calls["marts/refund_insights"]
    assert "Exchange" not in lying._jdf.queryExecution().executedPlan().toString()
    names = {r.transaction_id: r.merchant_name for r in
             spark.read.parquet(f"{cfg.warehouse}/marts/transaction_performance").collect()}
    assert names == {"T1": "M1", "T2": "M2", "T3": "M2"}
    names = {r.refund_id: r.merchant_name for r in spark.read.parquet(f"{cfg.warehouse}/marts/refund_insights").collect()}
    assert names == {"R1": "M1", "R3": "M2", "R9": None}
