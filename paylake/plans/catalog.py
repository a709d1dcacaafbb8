"""Query keys -> Spark DataFrames over the given tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  Keys that
exercise a sink or a file source first write Spark-derived data to a fresh
folder below the session's shared checkpoint folder (``session.scratch_dir``)
and then return the DataFrame that reads it back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import paths as P
from ..operators import dedup, kpis, ledger, marts, profile, quality
from ..session import release_shuffles, scratch_dir
from ..sinks import keyindex
from ..sinks import parquet as sinks
from ..sources import csv as csvsrc
from ..sources import files as filesrc
from ..sources import tables as fx
from ..streaming import ingest
from ..streaming import marts as stream_marts
from .together import together


class Marts:
    """The three marts of one ``(spark, sf_dir)``.

    Every dataset enters a mart with a primary key (null-key rows are
    quarantine material) and deduplicated on it.  Transactions are
    deduplicated once; refunds and settlements derive one row per surviving
    transaction, so they are unique by construction and need no second
    shuffle.  All consumers of the deduplicated transactions share one
    identical subplan (the key filter is explicit, not inferred per join), so
    AQE reuses its shuffle instead of recomputing it per consumer.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.transactions_fixture = fx.transactions_keyed(spark, sf_dir)
        txn = fx.transactions_clean(self.transactions_fixture)
        merchant = dedup.latest_by_key(fx.merchants(spark, sf_dir), "merchant_id")
        channel = dedup.latest_by_key(fx.channels(spark, sf_dir), "channel_id")
        customer = dedup.latest_by_key(fx.customers(spark, sf_dir), "customer_id")
        refunds = fx.refunds_from(self.transactions_fixture)
        settlements = fx.settlements_from(self.transactions_fixture)
        self.transaction = marts.transaction_performance(txn, merchant, channel)
        self.settlement = marts.merchant_settlement(settlements, txn, merchant)
        self.refund = marts.refund_insights(refunds, txn, merchant, customer)


def _txn_kpi(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: fn(Marts(spark, d).transaction)


def _stl_kpi(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: fn(Marts(spark, d).settlement)


def _ref_kpi(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: fn(Marts(spark, d).refund)


def _refund_rate(spark: SparkSession, d: str) -> DataFrame:
    m = Marts(spark, d)
    return kpis.refund_rate(m.refund, m.transaction)


# ------------------------------------------------------------ files & paths

BUCKET = "bucket"


def _route_files(spark: SparkSession, d: str) -> DataFrame:
    f = fx.file_paths(spark, d)
    return f.select("event_id", "file_path", P.file_name("file_path").alias("file_name"),
                    P.route_dataset("file_path").alias("dataset"))


def _file_extension(spark: SparkSession, d: str) -> DataFrame:
    f = fx.file_paths(spark, d)
    return f.select("event_id", "file_path", P.is_csv("file_path").alias("is_valid"))


def _path_normalize(spark: SparkSession, d: str) -> DataFrame:
    f = fx.file_paths(spark, d)
    key = P.object_key("file_path", BUCKET)
    return f.select("event_id",
                    P.has_object_scheme("file_path").alias("is_valid_scheme"),
                    key.alias("source_key"),
                    P.key_file_name(key).alias("file_name"),
                    P.destination_key(key, "processing/").alias("destination_key"),
                    P.join_path("s3a", BUCKET, "processed/", P.key_file_name(key))
                     .alias("processed_path"))


def _csv_scan(spark: SparkSession, d: str) -> DataFrame:
    """Write the transaction fixture as headed CSV, scan it back with the schema."""
    out = scratch_dir(spark, "landing-fact_transactions")
    csvsrc.write_csv(fx.transactions_clean(fx.transactions_raw(spark, d)), out)
    return csvsrc.read_csv(spark, out, S.TRANSACTIONS.schema)


def _settlement_drops(spark: SparkSession, d: str) -> str:
    """Settlements written as one CSV drop folder per settlement year."""
    root = scratch_dir(spark, "landing-settlements")
    stl = fx.settlements_from(fx.transactions_by_order(spark, d))
    (stl.withColumn("drop", F.year("settlement_date")).write.partitionBy("drop")
        .option("header", "true").csv(root))
    return root


def _multi_file_union(spark: SparkSession, d: str) -> DataFrame:
    """Every drop folder of one dataset read by one multi-path scan."""
    root = _settlement_drops(spark, d)
    folders = sorted({r.parent for r in filesrc.list_files(spark, root, "*.csv")
                      .select("parent").distinct().collect()})
    return csvsrc.read_csv(spark, [f"{root}/{p}" for p in folders], S.SETTLEMENTS.schema)


def _list_files(spark: SparkSession, d: str) -> DataFrame:
    root = _settlement_drops(spark, d)
    return (filesrc.list_files(spark, root, "*.csv").where(F.col("length") > 0)
                   .select("parent").distinct())


# ------------------------------------------------------------------- sinks

def _written_mart(spark: SparkSession, d: str, kind: str) -> str:
    m = Marts(spark, d)
    df = {"transaction_performance": m.transaction, "merchant_settlement": m.settlement,
          "refund_insights": m.refund}[kind]
    out = scratch_dir(spark, f"mart-{kind}")
    sinks.write_partitioned(df, out, marts.PARTITION_COLUMNS[kind], mode="append")
    return out


def _mart_year_scan(spark: SparkSession, d: str) -> DataFrame:
    path = _written_mart(spark, d, "transaction_performance")
    return filesrc.read_mart(spark, path, "transaction_performance", year=1995)


def _partitioned_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = _written_mart(spark, d, "merchant_settlement")
    return filesrc.read_mart(spark, path, "merchant_settlement")


def _idempotent_append(spark: SparkSession, d: str) -> DataFrame:
    """A partial batch, then the full batch twice: every refund ends up once."""
    kind = "refund_insights"
    # three appends reuse one computed mart (recomputed from lineage if a
    # cached block is lost with its executor)
    mart = Marts(spark, d).refund.persist(StorageLevel.MEMORY_AND_DISK)
    out = scratch_dir(spark, f"mart-{kind}")
    parts, key = marts.PARTITION_COLUMNS[kind], marts.MART_KEYS[kind]
    sinks.idempotent_append(mart.where(F.col("refund_reason") == "SERVICE_ISSUE"), out, key, parts)
    sinks.idempotent_append(mart, out, key, parts)
    sinks.idempotent_append(mart, out, key, parts)
    mart.unpersist()
    return filesrc.read_mart(spark, out, kind)


def _indexed_append(spark: SparkSession, d: str) -> DataFrame:
    """Some refunds, then all (those again, but dated for another month) twice: each
    ends up once, as first sent."""
    kind = "refund_insights"
    mart = Marts(spark, d).refund.persist(StorageLevel.MEMORY_AND_DISK)
    out = scratch_dir(spark, f"mart-{kind}")
    parts, key = marts.PARTITION_COLUMNS[kind], marts.MART_KEYS[kind]
    first = F.col("refund_reason") == "SERVICE_ISSUE"
    keyindex.indexed_append(mart.where(first), out, key, parts)
    moved = mart.withColumn("refund_month", F.when(first, F.col("refund_month") % 12 + 1).otherwise(F.col("refund_month")))
    for _ in range(2):
        keyindex.indexed_append(moved, out, key, parts)
    mart.unpersist()
    return filesrc.read_mart(spark, out, kind)


# ------------------------------------------------------------- validation

def _missing_columns(spark: SparkSession, d: str) -> DataFrame:
    """Header check of every landing file: the six datasets as CSV, plus a
    refunds drop whose producer left out ``refund_status``."""
    root = scratch_dir(spark, "landing-headers")
    ds = fx.payment_datasets(spark, d)
    # three files come from the deduplicated transactions: computed once
    keyed = fx.transactions_by_order(spark, d).persist(StorageLevel.MEMORY_AND_DISK)
    ds |= {"refunds": fx.refunds_from(keyed), "settlements": fx.settlements_from(keyed)}
    for name, df in ds.items():
        csvsrc.write_csv(df, f"{root}/{S.BY_NAME[name].token}")
    csvsrc.write_csv(ds["refunds"].drop("refund_status"), f"{root}/fact_refunds_bad")
    keyed.unpersist()
    heads = quality.csv_headers(spark, f"{root}/*/*.csv")
    folder = F.element_at(F.split("file_path", "/"), -2)
    required = F.lit(None).cast("array<string>")
    for spec in reversed(S.DATASETS):
        required = F.when(folder.startswith(spec.token),
                          F.array(*[F.lit(c) for c in spec.columns])).otherwise(required)
    checked = quality.missing_columns(heads.withColumn("required", required), "required")
    return checked.select(folder.alias("folder"),
                          F.array_join("missing", ",").alias("missing_columns"),
                          "is_valid").distinct()


def _datasets(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return fx.payment_datasets(spark, d)


def _dedup_datasets(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {name: dedup.latest_by_key(df, S.BY_NAME[name].pk)
            for name, df in fx.payment_datasets(spark, d).items()}


def _pk_duplicates(spark: SparkSession, d: str) -> DataFrame:
    parts = [quality.pk_duplicates(df, S.BY_NAME[name].pk)
             .select(F.lit(name).alias("dataset"),
                     F.col(S.BY_NAME[name].pk).cast("string").alias("key_value"), "n_rows")
             for name, df in _datasets(spark, d).items()]
    return csvsrc.union_by_name(parts)


# ------------------------------------------------------------------ ledger

def _ledger_current(spark: SparkSession, d: str) -> DataFrame:
    return ledger.current_state(ledger.from_file_events(fx.file_events(spark, d)))


def _led_current(spark: SparkSession, d: str) -> DataFrame:
    return _ledger_current(spark, d).select("file_name", "status", "error_type", "created_date",
                                            "updated_date", "attempts")


def _led_retryable(spark: SparkSession, d: str) -> DataFrame:
    return ledger.retryable(_ledger_current(spark, d)).select("file_name", "error_type",
                                                              "attempts")


def _led_stale(spark: SparkSession, d: str) -> DataFrame:
    return ledger.stale_active_events(_ledger_current(spark, d)).select(
        "file_name", "status", "error_type", "error_message")


# ------------------------------------------------------------------ the job

def _job_run_batch(spark: SparkSession, d: str) -> DataFrame:
    """End to end: the six datasets land as CSV drop folders, one ``run_batch``
    validates, loads, deduplicates, builds and appends the marts and writes
    the KPIs; the result is the written monthly-success-by-channel KPI."""
    from .batch import BatchConfig, run_batch

    root = scratch_dir(spark, "job")
    # landing the drops reuses one computed transaction set for three files
    txn = fx.transactions_by_order(spark, d).persist(StorageLevel.MEMORY_AND_DISK)
    drops = {"customer": fx.customers(spark, d), "merchant": fx.merchants(spark, d),
             "channel": fx.channels(spark, d), "transactions": fx.transactions_clean(txn),
             "refunds": fx.refunds_from(txn), "settlements": fx.settlements_from(txn)}
    for name, df in drops.items():
        csvsrc.write_csv(df, f"{root}/landing/{S.BY_NAME[name].token}_drop1")
    txn.unpersist()
    release_shuffles(spark)
    cfg = BatchConfig(landing=f"{root}/landing", warehouse=f"{root}/warehouse",
                      ledger=f"{root}/ledger", route_by_folder=True)
    run_batch(spark, cfg)
    return spark.read.parquet(f"{cfg.warehouse}/kpis/monthly_channel_success")


def _land_and_run(spark: SparkSession, cfg, batches, computed: DataFrame) -> None:
    """Lands each batch's drops in a folder of its own, lets go of the rows ``computed`` for
    them, then runs the batches one after the other: they have all the memory."""
    from .batch import run_batch

    landings = [f"{cfg.landing}/batch{n}" for n in range(len(batches))]
    for n, (landing, drops) in enumerate(zip(landings, batches)):
        for name, df in drops.items():
            csvsrc.write_csv(df, f"{landing}/{S.BY_NAME[name].token}_drop{n}")
    computed.unpersist()
    release_shuffles(spark)
    for landing in landings:
        run_batch(spark, replace(cfg, landing=landing))


def _job_late_transactions(spark: SparkSession, d: str) -> DataFrame:
    """Two batches: refunds and one half of the transactions, then channels and the
    other half.  Refunds that came before their transaction find it in the end."""
    from .batch import BatchConfig

    root = scratch_dir(spark, "job-late")
    cfg = BatchConfig(landing=f"{root}/landing", warehouse=f"{root}/warehouse",
                      ledger=f"{root}/ledger", route_by_folder=True)
    keyed = fx.transactions_by_order(spark, d).persist(StorageLevel.MEMORY_AND_DISK)
    txn = fx.transactions_clean(keyed)
    late = F.crc32(F.col("transaction_id").cast("binary")) % 2 == 0
    batches = ({"merchant": fx.merchants(spark, d), "customer": fx.customers(spark, d),
                "transactions": txn.where(~late), "refunds": fx.refunds_from(keyed)},
               {"channel": fx.channels(spark, d), "transactions": txn.where(late)})
    _land_and_run(spark, cfg, batches, keyed)
    return filesrc.read_mart(spark, f"{cfg.warehouse}/marts/refund_insights", "refund_insights")


def _job_late_dimensions(spark: SparkSession, d: str) -> DataFrame:
    """Two batches: all facts with one half of each dimension's rows, then the other
    halves.  Mart rows built without their dimension rows get them in the end."""
    from .batch import BatchConfig

    root = scratch_dir(spark, "job-late-dimensions")
    cfg = BatchConfig(landing=f"{root}/landing", warehouse=f"{root}/warehouse",
                      ledger=f"{root}/ledger", route_by_folder=True)
    keyed = fx.transactions_by_order(spark, d).persist(StorageLevel.MEMORY_AND_DISK)
    dims = {"merchant": fx.merchants(spark, d), "customer": fx.customers(spark, d), "channel": fx.channels(spark, d)}
    late = {name: F.crc32(F.col(S.BY_NAME[name].pk).cast("string").cast("binary")) % 2 == 0 for name in dims}
    batches = ({**{name: df.where(~late[name]) for name, df in dims.items()},
                "transactions": fx.transactions_clean(keyed), "refunds": fx.refunds_from(keyed),
                "settlements": fx.settlements_from(keyed)},
               {name: df.where(late[name]) for name, df in dims.items()})
    _land_and_run(spark, cfg, batches, keyed)
    return filesrc.read_mart(spark, f"{cfg.warehouse}/marts/refund_insights", "refund_insights")


def _job_fact_update(spark: SparkSession, d: str) -> DataFrame:
    """Two batches: all facts, many with another state, amount or month; then those again as
    they are.  Base and marts show the newer files' rows."""
    from .batch import BatchConfig

    root = scratch_dir(spark, "job-update")
    cfg = BatchConfig(landing=f"{root}/landing", warehouse=f"{root}/warehouse",
                      ledger=f"{root}/ledger", route_by_folder=True)
    keyed = fx.transactions_by_order(spark, d).persist(StorageLevel.MEMORY_AND_DISK)
    txn, refunds = fx.transactions_clean(keyed), fx.refunds_from(keyed)

    def some(key: str):
        return F.crc32(F.col(key).cast("binary")) % 3 == 0

    def early(key: str, column: str, value):
        return F.when(some(key), value).otherwise(F.col(column))

    before = txn.withColumns({
        "transaction_status": early("transaction_id", "transaction_status", F.lit("PENDING")),
        "merchant_id": early("transaction_id", "merchant_id", F.col("merchant_id") + 1),
        "transaction_timestamp": early("transaction_id", "transaction_timestamp",
                                       F.col("transaction_timestamp") - F.expr("interval 40 days"))})
    asked = refunds.withColumns({
        "refund_status": early("refund_id", "refund_status", F.lit("REQUESTED")),
        "refund_timestamp": early("refund_id", "refund_timestamp",
                                  F.col("refund_timestamp") - F.expr("interval 3 years"))})
    batches = ({"merchant": fx.merchants(spark, d), "customer": fx.customers(spark, d), "channel": fx.channels(spark, d),
                "transactions": before, "refunds": asked},
               {"transactions": txn.where(some("transaction_id")), "refunds": refunds.where(some("refund_id"))})
    _land_and_run(spark, cfg, batches, keyed)
    return filesrc.read_mart(spark, f"{cfg.warehouse}/marts/refund_insights", "refund_insights")


# --------------------------------------------------------------- streaming

def _stream_ingest_once(spark: SparkSession, d: str) -> DataFrame:
    """Land the transaction files, ingest them with two availableNow runs of one
    file stream (the second finds nothing new), archive what was read."""
    root = scratch_dir(spark, "stream-ingest")
    landing = f"{root}/landing/fact_transactions"
    csvsrc.write_csv(fx.transactions_clean(fx.transactions_raw(spark, d)), landing)
    for _ in range(2):
        stream = ingest.file_stream(spark, landing, S.TRANSACTIONS,
                                    archive_dir=f"{root}/processed")
        ingest.ingest_available(stream, f"{root}/sink", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/sink")


def _stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Two daily drops (closed lines first, open lines a run later) repeat many
    transaction ids; the deduplicating stream keeps each id once, first drop wins."""
    root = scratch_dir(spark, "stream-dedup")
    landing, sink, ckpt = f"{root}/landing", f"{root}/sink", f"{root}/_checkpoint"
    raw = fx.transactions_raw(spark, d)
    for status in ("F", "O"):
        csvsrc.write_csv(fx.transactions_clean(raw.where(F.col("l_linestatus") == status)),
                         landing, mode="append")
        ingest.dedup_into(ingest.file_stream(spark, landing, S.TRANSACTIONS), sink, ckpt,
                          key="transaction_id", order=("transaction_timestamp",))
    return spark.read.parquet(sink)


#: Days after which the watermark stream may forget a transaction, and after which it is sent again.
KEPT_DAYS, SOON_DAYS, LATE_YEARS = 365, 180, 4


def _stream_watermark(spark: SparkSession, d: str) -> DataFrame:
    """One drop a year of event time, each a run of its own from the checkpoint.  Every
    drop sends the transactions of the year before again, dated 180 days later (inside the delay:
    dropped), and those of four years before, dated four years later (forgotten by then: kept)."""
    root = scratch_dir(spark, "stream-watermark")
    landing = f"{root}/landing"
    at = F.col("transaction_timestamp")
    txn = (fx.transactions_clean(fx.transactions_by_order(spark, d)).where(at.isNotNull())
           .persist(StorageLevel.MEMORY_AND_DISK))
    years = sorted(r[0] for r in txn.select(F.year(at)).distinct().collect())
    soon = txn.where(F.year(at) < years[-1])
    sent = (txn.withColumn("_drop", F.year(at))
            .unionByName(soon.withColumn("_drop", F.year(at) + 1)
                         .withColumn("transaction_timestamp", at + F.expr(f"interval {SOON_DAYS} days")))
            .unionByName(txn.withColumn("_drop", F.year(at) + LATE_YEARS).where(F.col("_drop") <= years[-1])
                         .withColumn("transaction_timestamp", at + F.expr(f"interval {LATE_YEARS} years"))))
    for year in years:
        csvsrc.write_csv(sent.where(F.col("_drop") == year).drop("_drop"), landing, mode="append")
        ingest.dedup_within(ingest.file_stream(spark, landing, S.TRANSACTIONS), f"{root}/sink", f"{root}/_checkpoint",
                            "transaction_id", "transaction_timestamp", f"{KEPT_DAYS} days")
    txn.unpersist()
    return spark.read.parquet(f"{root}/sink").select("transaction_id", "transaction_timestamp", "transaction_amount")


def _stream_marts(spark: SparkSession, d: str) -> DataFrame:
    """Three drops of transactions and refunds, by their own dates, go through the streams
    to the refund mart; many refunds come before their transaction, some have none.  With each
    comes a refund file whose first two columns are swapped, which must not be read."""
    root = scratch_dir(spark, "stream-marts")
    # a refund's date may lie years from its transaction's in these tables
    cfg = stream_marts.StreamConfig(f"{root}/warehouse", f"{root}/ledger", delay="30 days", wait="2600 days")
    keyed = fx.transactions_by_order(spark, d).persist(StorageLevel.MEMORY_AND_DISK)
    merchant = dedup.latest_by_key(fx.merchants(spark, d), "merchant_id")
    customer = dedup.latest_by_key(fx.customers(spark, d), "customer_id")
    refunds = fx.refunds_from(keyed).select(*S.REFUNDS.columns)
    swapped = S.REFUNDS.columns[1::-1] + S.REFUNDS.columns[2:]
    drops = {"transactions": (S.TRANSACTIONS, fx.transactions_clean(keyed), "transaction_timestamp"),
             "refunds": (S.REFUNDS, refunds, "refund_timestamp")}

    def build(facts: DataFrame, transactions: DataFrame) -> DataFrame:
        return marts.refund_insights(facts, transactions, merchant, customer)

    part = F.when(F.col("_y") <= 1997, 0).when(F.col("_y") <= 1999, 1).otherwise(2)

    def drop(n: int, name: str) -> None:
        spec, df, event = drops[name]
        rows = df.withColumn("_y", F.year(event)).where(part == n).drop("_y")
        csvsrc.write_csv(rows, f"{root}/landing/{name}", mode="append")
        if name == "refunds":
            csvsrc.write_csv(rows.withColumn("refund_id", F.concat(F.lit("BAD"), "refund_id")).select(*swapped),
                             f"{root}/landing/{name}", mode="append")
        stream_marts.ingest_checked(spark, f"{root}/landing/{name}", spec, cfg)

    for n in range(3):
        # the two landing folders have streams and base tables of their own
        together(spark, [partial(drop, n, name) for name in drops])
        stream_marts.run_mart(spark, "refund_insights", build, cfg)
    keyed.unpersist()
    stream_marts.catch_up(spark, "refund_insights", build, cfg, close=True)
    return filesrc.read_mart(spark, cfg.mart("refund_insights"), "refund_insights")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "mart_transaction_performance": lambda spark, d: Marts(spark, d).transaction,
    "mart_merchant_settlement": lambda spark, d: Marts(spark, d).settlement,
    "mart_refund_insights": lambda spark, d: Marts(spark, d).refund,
    "kpi_daily_volume": _txn_kpi(kpis.daily_volume),
    "kpi_success_rate": _txn_kpi(kpis.success_rate),
    "kpi_channel_revenue": _txn_kpi(kpis.channel_revenue),
    "kpi_city_payments": _txn_kpi(kpis.city_payments),
    "kpi_monthly_channel_success": _txn_kpi(kpis.monthly_channel_success),
    "kpi_monthly_settled": _stl_kpi(kpis.monthly_settled),
    "kpi_pending_settlement_pct": _stl_kpi(kpis.pending_settlement_pct),
    "kpi_merchant_payout": _stl_kpi(kpis.merchant_payout),
    "kpi_category_fee_revenue": _stl_kpi(kpis.category_fee_revenue),
    "kpi_refund_rate": _refund_rate,
    "kpi_top_refund_merchants": _ref_kpi(kpis.top_refund_merchants),
    "kpi_refund_reasons": _ref_kpi(kpis.refund_reasons),
    "kpi_repeat_refund_customers": _ref_kpi(kpis.repeat_refund_customers),
    "ded_latest_by_key": lambda spark, d: fx.transactions(spark, d),
    "ded_drop_duplicates": lambda spark, d: dedup.drop_duplicates(
        fx.transactions_raw(spark, d), "transaction_id").select("transaction_id"),
    "src_csv_scan": _csv_scan,
    "src_route_files": _route_files,
    "src_multi_file_union": _multi_file_union,
    "src_mart_year_scan": _mart_year_scan,
    "src_list_files": _list_files,
    "snk_partitioned_roundtrip": _partitioned_roundtrip,
    "snk_idempotent_append": _idempotent_append,
    "snk_indexed_append": _indexed_append,
    "val_file_extension": _file_extension,
    "val_missing_columns": _missing_columns,
    "path_normalize": _path_normalize,
    "prof_dataset_counts": lambda spark, d: profile.dataset_counts(_dedup_datasets(spark, d)),
    "dq_pk_duplicates": _pk_duplicates,
    "dq_fk_orphans": lambda spark, d: quality.fk_orphan_summary(_datasets(spark, d)),
    "dq_domain_violations": lambda spark, d: quality.domain_violations(_datasets(spark, d)),
    "led_current_state": _led_current,
    "led_retryable": _led_retryable,
    "led_stale_active": _led_stale,
    "job_run_batch": _job_run_batch,
    "job_late_transactions": _job_late_transactions,
    "job_late_dimensions": _job_late_dimensions,
    "job_fact_update": _job_fact_update,
    "stream_ingest_once": _stream_ingest_once,
    "stream_dedup": _stream_dedup,
    "stream_watermark": _stream_watermark,
    "stream_marts": _stream_marts,
}
