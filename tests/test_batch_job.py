"""End-to-end batch job on hand-made CSV drops: ledger, retries, idempotent marts."""

import pytest

from conftest import write_text
from paylake.operators import ledger
from paylake.plans.batch import BatchConfig, run_batch

CUSTOMER = """customer_id,customer_name,age_group,city,state,signup_date,kyc_status,preferred_channel_id
1,Asha,18-25,Pune,MH,2025-01-01,VERIFIED,1
2,Ravi,26-35,Delhi,DL,2025-02-01,PENDING,2
"""
MERCHANT = """merchant_id,merchant_name,merchant_category,city,state,onboard_date,risk_tier,settlement_cycle
1,M1,Food,Pune,MH,2024-01-01,LOW,T+1
2,M2,Fuel,Delhi,DL,2024-01-01,HIGH,T+2
"""
CHANNEL = """channel_id,channel_type,provider_name
1,UPI,PhonePe
2,CARD,Visa
"""
TXN = """transaction_id,customer_id,merchant_id,channel_id,transaction_timestamp,transaction_amount,transaction_status,failure_reason,device_type,bank_name,city,processing_fee
T1,1,1,1,2026-01-01 10:00:00,100.00,SUCCESS,,MOBILE,HDFC,Pune,1.50
T2,2,2,2,2026-01-01 11:00:00,50.00,FAILED,BANK_TIMEOUT,WEB,SBI,Delhi,0.75
T3,1,2,1,2026-02-03 09:00:00,20.00,SUCCESS,,POS,ICICI,Pune,0.30
T3,1,2,1,2026-02-03 09:00:00,20.00,SUCCESS,,POS,ICICI,Pune,0.30
"""
SETTLE = """settlement_id,merchant_id,transaction_id,settlement_date,gross_amount,fee_amount,net_amount,settlement_status
S1,1,T1,2026-01-02,100.00,1.50,98.50,SETTLED
S3,2,T3,2026-02-04,20.00,0.30,19.70,PENDING
"""
REFUND_LATE = """refund_id,transaction_id,customer_id,refund_timestamp,refund_amount,refund_reason,refund_status
R1,T1,1,2026-01-05 12:00:00,40.00,SERVICE_ISSUE,COMPLETED
R9,TX,2,2026-01-06 12:00:00,5.00,DUPLICATE_PAYMENT,COMPLETED
"""


def _drop(root, day):
    write_text(f"{root}/dim_customer_{day}.csv", CUSTOMER)
    write_text(f"{root}/dim_merchant_{day}.csv", MERCHANT)
    write_text(f"{root}/dim_payment_channel_{day}.csv", CHANNEL)
    write_text(f"{root}/fact_transactions_{day}.csv", TXN)
    write_text(f"{root}/fact_settlements_{day}.csv", SETTLE)
    write_text(f"{root}/readme_{day}.json", "{}")
    write_text(f"{root}/unknown_{day}.csv", "a,b\n1,2\n")


@pytest.fixture()
def cfg(tmp_path):
    return BatchConfig(landing=f"{tmp_path}/landing", warehouse=f"{tmp_path}/wh",
                       ledger=f"{tmp_path}/ledger")


def _mart(spark, cfg, kind):
    return spark.read.parquet(f"{cfg.warehouse}/marts/{kind}")


def test_batch_end_to_end_with_retry_and_late_refund(spark, cfg):
    _drop(cfg.landing, "20260101")

    # first run dies after the settlement mart was written
    with pytest.raises(RuntimeError):
        run_batch(spark, cfg, fail_after="merchant_settlement")
    cur = ledger.current_state(spark.read.parquet(cfg.ledger))
    st = {r.file_name: (r.status, r.error_type) for r in cur.collect()}
    assert st["fact_transactions_20260101.csv"] == ("F", "SYSTEM_FAILURE")
    assert st["readme_20260101.json"] == ("F", "INVALID_FILE")
    assert st["unknown_20260101.csv"] == ("F", "UNKNOWN_DATASET")

    # the retry re-reads the failed files; marts hold every key once
    res = run_batch(spark, cfg)
    assert len(res.processed_files) == 5
    txn = _mart(spark, cfg, "transaction_performance")
    assert sorted(r.transaction_id for r in txn.collect()) == ["T1", "T2", "T3"]
    stl = _mart(spark, cfg, "merchant_settlement")
    assert sorted(r.settlement_id for r in stl.collect()) == ["S1", "S3"]
    assert res.record_counts == {"customer": 2, "merchant": 2, "channel": 2}
    kp = {k: v.collect() for k, v in res.kpis.items()}
    assert kp["success_rate"][0].success_rate == pytest.approx(66.67)
    assert kp["pending_settlement_pct"][0].pending_settlement_pct == 50.0
    assert [r.Day for r in kp["daily_volume"]] == ["2026-01-01", "2026-02-03"]
    st = {r.file_name: r.status for r in
          ledger.current_state(spark.read.parquet(cfg.ledger)).collect()}
    assert st["fact_transactions_20260101.csv"] == "C"

    # nothing new: nothing processed, nothing duplicated
    again = run_batch(spark, cfg)
    assert again.processed_files == []
    assert _mart(spark, cfg, "transaction_performance").count() == 3

    # a refund arriving in a later drop still finds its transaction
    write_text(f"{cfg.landing}/fact_refunds_20260106.csv", REFUND_LATE)
    res3 = run_batch(spark, cfg)
    assert res3.processed_files and res3.processed_files[0].endswith("fact_refunds_20260106.csv")
    ref = {r.refund_id: r for r in _mart(spark, cfg, "refund_insights").collect()}
    assert ref["R1"].transaction_status == "SUCCESS" and ref["R1"].merchant_name == "M1"
    assert ref["R1"].age_group == "18-25"
    assert ref["R9"].transaction_status is None and ref["R9"].merchant_id is None
    rr = res3.kpis["refund_rate"].collect()[0]
    assert (rr.refund_txn, rr.total_success_txn, rr.refund_rate) == (2, 2, 100.0)
    # base transactions were deduplicated (T3 sent twice)
    assert spark.read.parquet(f"{cfg.warehouse}/base/transactions").count() == 3


def test_quarantine_and_dimension_update(spark, cfg):
    write_text(f"{cfg.landing}/dim_payment_channel_1.csv", CHANNEL + "x,BAD,Row\n,NOKEY,Row\n")
    run_batch(spark, cfg)
    q = spark.read.parquet(f"{cfg.warehouse}/quarantine/channel")
    assert sorted(r._reason for r in q.collect()) == ["MALFORMED", "NULL_PK"]
    # a re-sent dimension row with a new value: the latest file wins
    import os
    import time
    time.sleep(1.1)
    p = write_text(f"{cfg.landing}/dim_payment_channel_2.csv",
                   "channel_id,channel_type,provider_name\n1,UPI,GPay\n")
    os.utime(p)
    run_batch(spark, cfg)
    from paylake.plans.batch import _dims_current
    cur = {r.channel_id: r.provider_name for r in _dims_current(spark, cfg.warehouse)["channel"].collect()}
    assert cur == {1: "GPay", 2: "Visa"}


HEAD = TXN.splitlines()[0] + "\n"


def _state(spark, cfg):
    return {r.file_name: (r.status, r.error_type) for r in
            ledger.current_state(spark.read.parquet(cfg.ledger)).collect()}


def test_failures_do_not_use_up_healthy_files(spark, cfg):
    path = write_text(f"{cfg.landing}/fact_transactions 1.csv", TXN)       # a name with a space
    # simulate a crashed run: the file was left Active
    from paylake import schemas as S
    files = spark.createDataFrame([(f"file:{path}", "fact_transactions 1.csv")], "path string, file_name string")
    ev = ledger.events_for(files, "A", location_col="path")
    ev.select(*S.LEDGER_EVENT.fieldNames()).write.mode("append").parquet(cfg.ledger)
    for _ in range(3):
        with pytest.raises(RuntimeError):
            run_batch(spark, cfg, fail_after="load")
    res = run_batch(spark, cfg)
    assert len(res.processed_files) == 1 and res.rejected_files == {}
    assert _state(spark, cfg)["fact_transactions 1.csv"][0] == "C"


def test_attempt_cap_is_an_option_and_reported(spark, cfg):
    cfg.max_attempts = 1
    write_text(f"{cfg.landing}/fact_transactions_1.csv", TXN)
    with pytest.raises(RuntimeError):
        run_batch(spark, cfg, fail_after="load")
    res = run_batch(spark, cfg)
    assert res.processed_files == [] and len(res.parked_files) == 1


def test_file_known_by_path_and_time(spark, cfg):
    import os
    import time
    path = write_text(f"{cfg.landing}/d1/dim_payment_channel.csv", "channel_type,channel_id,provider_name\nUPI,1,X\n")
    write_text(f"{cfg.landing}/d2/dim_payment_channel.csv", CHANNEL)
    res = run_batch(spark, cfg)
    assert len(res.processed_files) == 1 and len(res.rejected_files) == 1
    assert run_batch(spark, cfg).processed_files == []
    time.sleep(1.1)
    write_text(path, "channel_id,channel_type,provider_name\n3,WALLET,Paytm\n")  # corrected, same name
    os.utime(path)
    res = run_batch(spark, cfg)
    assert [p.split("/")[-2] for p in res.processed_files] == ["d1"]
    from paylake.plans.batch import _dims_current
    assert _dims_current(spark, cfg.warehouse)["channel"].count() == 3


def test_vanished_retry_file_is_ledgered_and_stops_nothing(spark, cfg):
    import os
    path = write_text(f"{cfg.landing}/fact_transactions_1.csv", TXN)
    with pytest.raises(RuntimeError):
        run_batch(spark, cfg, fail_after="load")
    os.remove(path)
    write_text(f"{cfg.landing}/dim_payment_channel_1.csv", CHANNEL)
    res = run_batch(spark, cfg)
    assert len(res.processed_files) == 1 and len(res.missing_files) == 1
    assert _state(spark, cfg)["fact_transactions_1.csv"] == ("F", "FILE_NOT_FOUND")


def test_key_re_sent_in_another_month_and_late_dimensions(spark, cfg):
    write_text(f"{cfg.landing}/fact_transactions_1.csv", TXN)
    write_text(f"{cfg.landing}/fact_settlements_1.csv", SETTLE)
    run_batch(spark, cfg)                                     # facts before their dimensions
    write_text(f"{cfg.landing}/dim_merchant_1.csv", MERCHANT)
    write_text(f"{cfg.landing}/dim_payment_channel_1.csv", CHANNEL)
    run_batch(spark, cfg)
    assert _mart(spark, cfg, "transaction_performance").count() == 3
    assert _mart(spark, cfg, "merchant_settlement").count() == 2
    write_text(f"{cfg.landing}/fact_transactions_2.csv",
               HEAD + "T1,1,1,1,2026-05-01 10:00:00,100.00,SUCCESS,,MOBILE,HDFC,Pune,1.50\n")
    write_text(f"{cfg.landing}/fact_settlements_2.csv", SETTLE)
    run_batch(spark, cfg)
    assert spark.read.parquet(f"{cfg.warehouse}/base/transactions").count() == 3
    assert _mart(spark, cfg, "transaction_performance").count() == 3
    assert _mart(spark, cfg, "merchant_settlement").count() == 2


def test_late_dimension_rows_reach_all_marts(spark, cfg, tmp_path):
    whole = BatchConfig(landing=f"{tmp_path}/landing2", warehouse=f"{tmp_path}/wh2", ledger=f"{tmp_path}/ledger2")
    refunds = REFUND_LATE + "R2,T2,2,2026-01-07 12:00:00,5.00,SERVICE_ISSUE,COMPLETED\n"
    for c in (cfg, whole):
        write_text(f"{c.landing}/fact_transactions_1.csv", TXN)
        write_text(f"{c.landing}/fact_settlements_1.csv", SETTLE)
        write_text(f"{c.landing}/fact_refunds_1.csv", refunds)
    dims = {"dim_customer": CUSTOMER, "dim_merchant": MERCHANT, "dim_payment_channel": CHANNEL}
    for name, text in dims.items():
        write_text(f"{whole.landing}/{name}_1.csv", text)
        head, first, second, *_ = text.split("\n")
        write_text(f"{cfg.landing}/{name}_1.csv", f"{head}\n{first}\n")
    run_batch(spark, whole)
    run_batch(spark, cfg)
    assert _mart(spark, cfg, "transaction_performance").where("merchant_name is null").count() == 2
    for name, text in dims.items():
        head, first, second, *_ = text.split("\n")
        write_text(f"{cfg.landing}/{name}_2.csv", f"{head}\n{second}\n")
    with pytest.raises(RuntimeError):  # dies after a repair; the next run has the others left
        run_batch(spark, cfg, fail_after="transaction_performance")
    res = run_batch(spark, cfg)
    for kind in ("transaction_performance", "merchant_settlement", "refund_insights"):
        want = _mart(spark, whole, kind)
        assert sorted(map(str, _mart(spark, cfg, kind).select(*want.columns).collect())) == sorted(
            map(str, want.collect()))
    again = run_batch(spark, whole).kpis or {}
    assert not again and "success_rate" in res.kpis


def test_run_that_dies_between_base_and_marts_completes(spark, cfg):
    from paylake.plans.changes import BASED, ChangeLog

    _drop(cfg.landing, "20260101")
    write_text(f"{cfg.landing}/fact_refunds_20260106.csv", REFUND_LATE)
    with pytest.raises(RuntimeError):
        run_batch(spark, cfg, fail_after="base:refunds")  # settlements and transactions come after it
    log = ChangeLog(spark, f"{cfg.warehouse}/changes")
    assert len(log.batches("refunds", BASED, "refund_insights")) == 1
    run_batch(spark, cfg)
    log = ChangeLog(spark, f"{cfg.warehouse}/changes")
    assert spark.read.parquet(f"{cfg.warehouse}/base/refunds").count() == 2
    assert sorted(r.refund_id for r in _mart(spark, cfg, "refund_insights").collect()) == ["R1", "R9"]
    for kind, fact in (("transaction_performance", "transactions"), ("merchant_settlement", "settlements"),
                       ("refund_insights", "refunds")):
        assert log.batches(fact, BASED, kind) == []
        mart, base = _mart(spark, cfg, kind), spark.read.parquet(f"{cfg.warehouse}/base/{fact}")
        assert mart.count() == base.count() > 0


def test_stream_dedup_keeps_ledger(spark, tmp_path):
    from paylake import schemas as S
    from paylake.streaming import ingest
    landing = f"{tmp_path}/landing"
    write_text(f"{landing}/fact_transactions_1.csv", TXN)
    write_text(f"{landing}/fact_transactions_2.csv", TXN.replace("T1,", "T9,"))
    write_text(f"{landing}/notes.txt", "ignored")
    led = f"{tmp_path}/ledger"
    ingest.dedup_into(ingest.file_stream(spark, landing, S.TRANSACTIONS), f"{tmp_path}/sink",
                      f"{tmp_path}/ckpt", key="transaction_id",
                      order=("transaction_timestamp",), ledger_path=led)
    ids = sorted(r.transaction_id for r in spark.read.parquet(f"{tmp_path}/sink").collect())
    assert ids == ["T1", "T2", "T3", "T9"]
    cur = {r.file_name: r.status for r in
           ledger.current_state(spark.read.parquet(led)).collect()}
    assert cur == {"fact_transactions_1.csv": "C", "fact_transactions_2.csv": "C"}


def test_header_mismatch_fails_file_with_schema_failure(spark, cfg):
    write_text(f"{cfg.landing}/dim_payment_channel_ok.csv", CHANNEL)
    write_text(f"{cfg.landing}/dim_payment_channel_swapped.csv",
               "channel_type,channel_id,provider_name\nUPI,1,PhonePe\n")
    write_text(f"{cfg.landing}/dim_payment_channel_short.csv",
               "channel_id,channel_type\n3,WALLET\n")
    res = run_batch(spark, cfg)
    assert [p.rsplit("/", 1)[1] for p in res.processed_files] == ["dim_payment_channel_ok.csv"]
    cur = {r.file_name: (r.status, r.error_type, r.error_message) for r in
           ledger.current_state(spark.read.parquet(cfg.ledger)).collect()}
    assert cur["dim_payment_channel_swapped.csv"][:2] == ("F", "SCHEMA_FAILURE")
    assert "out of order" in cur["dim_payment_channel_swapped.csv"][2]
    assert "missing=['provider_name']" in cur["dim_payment_channel_short.csv"][2]
    assert spark.read.parquet(f"{cfg.warehouse}/base/channel").count() == 2


def test_incremental_summary_and_dimension_snapshots(spark, cfg):
    _drop(cfg.landing, "20260101")
    run_batch(spark, cfg)
    write_text(f"{cfg.landing}/fact_transactions_20260102.csv", TXN.splitlines()[0] + "\n"
               "T7,1,1,1,2026-01-01 18:00:00,10.00,SUCCESS,,MOBILE,HDFC,Pune,0.15\n")
    write_text(f"{cfg.landing}/dim_merchant_20260102.csv", MERCHANT.replace("M1,", "M1-renamed,"))
    res = run_batch(spark, cfg)
    vol = {r.Day: r.daily_transaction_volume for r in res.kpis["daily_volume"].collect()}
    assert vol == {"2026-01-01": 3, "2026-02-03": 1}       # January recomputed, February kept
    sr = res.kpis["success_rate"].collect()[0].success_rate
    assert sr == 75.0
    # two dimension snapshots exist; the current one has the renamed merchant
    base = spark.read.parquet(f"{cfg.warehouse}/base/merchant")
    assert base.select("_v").distinct().count() == 2
    from paylake.plans.batch import _dims_current
    cur = {r.merchant_id: r.merchant_name for r in _dims_current(spark, cfg.warehouse)["merchant"].collect()}
    assert cur == {1: "M1-renamed", 2: "M2"}
    t7 = [r for r in spark.read.parquet(f"{cfg.warehouse}/marts/transaction_performance").collect()
          if r.transaction_id == "T7"][0]
    assert t7.merchant_name == "M1-renamed"


def test_older_dimension_file_changes_nothing_and_late_transaction_is_found(spark, cfg):
    import os
    _drop(cfg.landing, "20260101")
    write_text(f"{cfg.landing}/fact_refunds_20260106.csv", REFUND_LATE)
    run_batch(spark, cfg)
    old = write_text(f"{cfg.landing}/dim_merchant_old.csv", MERCHANT.replace("M1,", "M1-old,"))
    os.utime(old, (1_600_000_000, 1_600_000_000))
    write_text(f"{cfg.landing}/fact_transactions_late.csv",
               HEAD + "TX,2,1,1,2025-12-30 10:00:00,5.00,SUCCESS,,MOBILE,HDFC,Pune,0.10\n")
    # dies once the mart is written; the summary still has to learn of the new month
    with pytest.raises(RuntimeError):
        run_batch(spark, cfg, fail_after="refund_insights")
    res = run_batch(spark, cfg)
    ref = {r.refund_id: r for r in _mart(spark, cfg, "refund_insights").collect()}
    assert sorted(ref) == ["R1", "R9"]
    assert (ref["R9"].merchant_name, ref["R9"].transaction_status, ref["R9"].age_group) == ("M1", "SUCCESS", "26-35")
    assert ref["R1"].merchant_name == "M1"
    vol = {r.Day: r.daily_transaction_volume for r in res.kpis["daily_volume"].collect()}
    assert vol == {"2025-12-30": 1, "2026-01-01": 2, "2026-02-03": 1}


def test_stream_quarantines_rows_without_key(spark, tmp_path):
    from paylake import schemas as S
    from paylake.streaming import ingest
    write_text(f"{tmp_path}/landing/fact_transactions_1.csv", TXN + TXN.splitlines()[1].replace("T1,", ",") + "\n")
    ingest.dedup_into(ingest.file_stream(spark, f"{tmp_path}/landing", S.TRANSACTIONS), f"{tmp_path}/sink",
                      f"{tmp_path}/ckpt", key="transaction_id", quarantine=f"{tmp_path}/bad")
    assert sorted(r.transaction_id for r in spark.read.parquet(f"{tmp_path}/sink").collect()) == ["T1", "T2", "T3"]
    assert [r._reason for r in spark.read.parquet(f"{tmp_path}/bad").collect()] == ["NULL_PK"]


def test_fk_orphans_in_one_pass_match_the_anti_join(spark):
    from paylake.operators import quality
    cust = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "customer_id int, preferred_channel_id int")
    chan = spark.createDataFrame([(1,), (None,)], "channel_id int")
    got = quality.fk_orphan_summary({"customer": cust, "channel": chan}).collect()
    want = quality.fk_orphans(cust, chan, "preferred_channel_id", "channel_id").count()
    assert [tuple(r) for r in got] == [("customer.preferred_channel_id->channel.channel_id", want)] and want == 1
    none = quality.fk_orphan_summary({"customer": cust.limit(0), "channel": chan}).collect()
    assert none[0].orphan_rows == 0
