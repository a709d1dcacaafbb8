"""Streams up to the marts, watermark deduplication."""

import datetime as dt
import glob
import os
from functools import partial

from conftest import write_text
from paylake import schemas as S
from paylake.operators import ledger, marts
from paylake.plans.together import together
from paylake.streaming import ingest, state
from paylake.streaming import marts as sm
from test_batch_job import CUSTOMER, HEAD, MERCHANT

REFUND_HEAD = ",".join(S.REFUNDS.columns) + "\n"


def _txn(tid, at):
    return f"{tid},1,1,1,{at},100.00,SUCCESS,,MOBILE,HDFC,Pune,1.50\n"


def _refund(rid, tid, at):
    return f"{rid},{tid},1,{at},40.00,SERVICE_ISSUE,COMPLETED\n"


def _csv(spark, tmp_path, name, text, spec):
    return spark.read.option("header", "true").schema(spec.schema).csv(write_text(f"{tmp_path}/{name}.csv", text))


def _ids(spark, path):
    return {r.refund_id: r.transaction_status for r in spark.read.parquet(path).collect()}


def test_refund_stream_waits_gives_up_and_catches_up(spark, tmp_path):
    cfg = sm.StreamConfig(f"{tmp_path}/wh", f"{tmp_path}/ledger", delay="1 days", wait="10 days")
    merchant, customer = _csv(spark, tmp_path, "m", MERCHANT, S.MERCHANT), _csv(spark, tmp_path, "c", CUSTOMER, S.CUSTOMER)
    mart = cfg.mart("refund_insights")

    def build(facts, transactions):
        return marts.refund_insights(facts, transactions, merchant, customer)

    def step(n, txn, refunds):
        write_text(f"{tmp_path}/in/t/fact_transactions_{n}.csv", HEAD + txn)
        write_text(f"{tmp_path}/in/r/fact_refunds_{n}.csv", REFUND_HEAD + refunds)
        sm.ingest_checked(spark, f"{tmp_path}/in/t", S.TRANSACTIONS, cfg)
        sm.ingest_checked(spark, f"{tmp_path}/in/r", S.REFUNDS, cfg)
        sm.run_mart(spark, "refund_insights", build, cfg)

    write_text(f"{tmp_path}/in/r/fact_refunds_swapped.csv",
               "transaction_id,refund_id," + ",".join(S.REFUNDS.columns[2:]) + "\n" + _refund("T1", "BAD", "2026-01-05 12:00:00"))
    step(1, _txn("T1", "2026-01-01 10:00:00"),
         _refund("R1", "T1", "2026-01-02 12:00:00") + _refund("R2", "T2", "2026-01-02 12:00:00")
         + _refund("R3", "NONE", "2026-01-02 12:00:00") + _refund("R1", "T1", "2026-01-02 12:00:00"))
    assert _ids(spark, mart) == {"R1": "SUCCESS"}  # R2, R3 wait
    # T2 comes a run later, and far from R4 in time; the watermark has not passed R3 yet
    step(2, _txn("T2", "2026-01-04 10:00:00"), _refund("R4", "T1", "2026-01-20 12:00:00"))
    assert _ids(spark, mart) == {"R1": "SUCCESS", "R2": "SUCCESS"}
    # time moves on: R3 goes out alone, R4 finds T1 in the base table although it lies beyond the wait
    step(3, _txn("T5", "2026-03-01 10:00:00"), _refund("R5", "T5", "2026-03-01 12:00:00"))
    assert _ids(spark, mart) == {"R1": "SUCCESS", "R2": "SUCCESS", "R3": None, "R4": "SUCCESS", "R5": "SUCCESS"}
    # too late for the watermark: the stream leaves it out, catching up does not; R7 still waits
    step(4, _txn("T6", "2026-03-02 10:00:00"),
         _refund("R6", "T1", "2026-01-03 12:00:00") + _refund("R7", "T9", "2026-03-02 12:00:00"))
    assert "R6" not in _ids(spark, mart)
    for _ in range(2):
        sm.catch_up(spark, "refund_insights", build, cfg)
        got = _ids(spark, mart)
        assert got["R6"] == "SUCCESS" and "R7" not in got
    sm.catch_up(spark, "refund_insights", build, cfg, close=True)
    assert _ids(spark, mart)["R7"] is None and spark.read.parquet(mart).count() == 7

    bad = spark.read.parquet(f"{cfg.warehouse}/quarantine/refunds_files").collect()
    assert len(bad) == 2 and all(r._source_file.endswith("fact_refunds_swapped.csv") for r in bad)
    state = {r.file_name: (r.status, r.error_type) for r in ledger.current_state(spark.read.parquet(cfg.ledger)).collect()}
    assert state.pop("fact_refunds_swapped.csv") == ("F", "SCHEMA_FAILURE")
    assert set(state.values()) == {("C", None)} and len(state) == 8


def test_replayed_micro_batch_adds_nothing(spark, tmp_path):
    cfg = sm.StreamConfig(f"{tmp_path}/wh", f"{tmp_path}/ledger")
    write_text(f"{tmp_path}/in/fact_transactions_1.csv", HEAD + _txn("T1", "2026-01-01 10:00:00") + _txn("", "2026-01-01 10:00:00"))
    for _ in range(2):
        sm.ingest_checked(spark, f"{tmp_path}/in", S.TRANSACTIONS, cfg)
        # as after a crash before the commit: the last micro-batch runs again
        os.remove(f"{cfg.work('ingest_transactions')}/checkpoint/commits/0")
        crc = f"{cfg.work('ingest_transactions')}/checkpoint/commits/.0.crc"
        if os.path.exists(crc):
            os.remove(crc)
    assert [r.transaction_id for r in spark.read.parquet(cfg.base("transactions")).collect()] == ["T1"]
    assert spark.read.parquet(f"{cfg.warehouse}/quarantine/transactions").count() == 1


def test_watermark_dedup_over_restarts(spark, tmp_path):
    def send(n, *rows):
        write_text(f"{tmp_path}/in/fact_transactions_{n}.csv", HEAD + "".join(_txn(*r) for r in rows))
        ingest.dedup_within(ingest.file_stream(spark, f"{tmp_path}/in", S.TRANSACTIONS), f"{tmp_path}/out",
                            f"{tmp_path}/ckpt", "transaction_id", "transaction_timestamp", "10 days")

    send(1, ("A", "2026-01-01 00:00:00"), ("B", "2026-01-02 00:00:00"))
    send(2, ("A", "2026-01-05 00:00:00"), ("C", "2026-01-06 00:00:00"))     # A again, inside the delay
    send(3, ("D", "2026-03-01 00:00:00"))                                   # the watermark passes A's time
    send(4, ("A", "2026-03-02 00:00:00"), ("E", "2026-01-03 00:00:00"))     # A counts as new, E is too late
    got = sorted((r.transaction_id, r.transaction_timestamp) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [("A", dt.datetime(2026, 1, 1)), ("A", dt.datetime(2026, 3, 2)), ("B", dt.datetime(2026, 1, 2)),
                   ("C", dt.datetime(2026, 1, 6)), ("D", dt.datetime(2026, 3, 1))]


def test_dedup_into_drops_repeats_by_watermark_and_sink(spark, tmp_path):
    for n, at in enumerate(("2026-01-01 00:00:00", "2026-01-03 00:00:00", "2026-05-01 00:00:00", "2026-05-02 00:00:00")):
        write_text(f"{tmp_path}/in/fact_transactions_{n}.csv", HEAD + _txn("A", at) + _txn(f"N{n}", at))
        ingest.dedup_into(ingest.file_stream(spark, f"{tmp_path}/in", S.TRANSACTIONS), f"{tmp_path}/out", f"{tmp_path}/ckpt",
                          key="transaction_id", watermark=("transaction_timestamp", "10 days"))
    assert sorted(r.transaction_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["A", "N0", "N1", "N2", "N3"]


def test_state_of_the_watermark_lies_in_rocksdb_and_is_bounded(spark, tmp_path):
    write_text(f"{tmp_path}/in/fact_transactions_1.csv", HEAD + _txn("A", "2026-01-01 00:00:00"))
    before = {k: spark.conf.get(k, None) for k in state.ON_DISK}
    ingest.dedup_within(ingest.file_stream(spark, f"{tmp_path}/in", S.TRANSACTIONS), f"{tmp_path}/out",
                        f"{tmp_path}/ckpt", "transaction_id", "transaction_timestamp", "10 days")
    with open(f"{tmp_path}/ckpt/offsets/0") as f:
        assert "RocksDBStateStoreProvider" in f.read()
    assert glob.glob(f"{tmp_path}/ckpt/state/0/0/*.changelog")  # what changed, not the whole store
    assert {k: spark.conf.get(k, None) for k in state.ON_DISK} == before
    assert state.ON_DISK[f"{state.ROCKSDB}.boundedMemoryUsage"] == "true"


def test_a_session_keeps_its_own_state_settings(spark):
    key = f"{state.ROCKSDB}.trackTotalNumberOfRows"
    spark.conf.set(key, "true")
    try:
        with state.state_on_disk(spark):
            assert spark.conf.get(key) == "true"
            assert spark.conf.get(state.STATE_STORE) == state.DISK_STORE
        assert spark.conf.get(key) == "true"
    finally:
        spark.conf.unset(key)


def test_streams_of_two_datasets_run_side_by_side(spark, tmp_path):
    """Both write the one ledger; neither loses an event."""
    cfg = sm.StreamConfig(f"{tmp_path}/wh", f"{tmp_path}/ledger", delay="1 days", wait="10 days")
    write_text(f"{tmp_path}/in/t/fact_transactions_1.csv", HEAD + _txn("T1", "2026-01-01 10:00:00"))
    write_text(f"{tmp_path}/in/r/fact_refunds_1.csv", REFUND_HEAD + _refund("R1", "T1", "2026-01-02 12:00:00"))
    together(spark, [partial(sm.ingest_checked, spark, f"{tmp_path}/in/t", S.TRANSACTIONS, cfg),
                     partial(sm.ingest_checked, spark, f"{tmp_path}/in/r", S.REFUNDS, cfg)])
    events = spark.read.parquet(cfg.ledger).select("file_name", "status").collect()
    assert sorted(map(tuple, events)) == [("fact_refunds_1.csv", "A"), ("fact_refunds_1.csv", "C"),
                                          ("fact_transactions_1.csv", "A"), ("fact_transactions_1.csv", "C")]
    assert spark.read.parquet(cfg.base("transactions")).count() == spark.read.parquet(cfg.base("refunds")).count() == 1
