"""Payment datasets projected from the given TPC-H-style tables.

These are the ``pay_*`` views of FIXTURES.md, built with the DataFrame API so
that every registered query reads the given tables and its work grows with
them.  Every function is lazy; nothing is collected.

Scale notes
-----------
* ``transactions_raw`` joins lineitem with orders (fact-to-fact, shuffled on
  the order key), customer (a large dimension at scale: shuffled, or
  broadcast by Spark when its measured size allows) and nation (25 rows).
* ``channels`` is a DISTINCT over orders: partial aggregation collapses it to
  at most a handful of rows per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.dedup import latest_by_key

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Order that picks the surviving row among duplicate transaction ids.
TXN_SURVIVOR_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
                      "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                      "l_linestatus")
# Helper columns carried by the transaction fixture; never part of a mart.
TXN_HELPERS = ("l_returnflag", "l_linestatus", "l_shipdate", "l_discount", "l_partkey",
               "l_suppkey", "l_quantity", "l_extendedprice", "l_tax")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given (read-only) table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _priority_digit() -> Column:
    return F.substr(F.col("o_orderpriority"), F.lit(1), F.lit(1))


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pay_channel: one row per order priority, priority 5 left out on purpose."""
    o = table(spark, sf_dir, "orders")
    return (o.where(_priority_digit() != F.lit("5"))
             .select(_priority_digit().cast("int").alias("channel_id"),
                     F.substr(F.col("o_orderpriority"), F.lit(3)).alias("channel_type"),
                     F.concat(F.lit("P"), _priority_digit()).alias("provider_name"))
             .distinct())


def _nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pay_merchant: suppliers; every tenth dropped so some facts find no merchant."""
    s = table(spark, sf_dir, "supplier")
    nr = _nation_region(spark, sf_dir)
    return (s.where(F.col("s_suppkey") % 10 != 0)
             .join(nr, s.s_nationkey == nr.n_nationkey)
             .select(F.col("s_suppkey").cast("int").alias("merchant_id"),
                     F.col("s_name").alias("merchant_name"),
                     F.col("r_name").alias("merchant_category"),
                     F.col("n_name").alias("city"),
                     F.col("r_name").alias("state"),
                     F.lit("2023-01-01").cast("date").alias("onboard_date"),
                     F.when(F.col("s_acctbal") < 3000, "LOW")
                      .when(F.col("s_acctbal") < 6000, "MEDIUM")
                      .otherwise("HIGH").alias("risk_tier"),
                     F.concat(F.lit("T+"), (F.col("s_suppkey") % 3 + 1).cast("string"))
                      .alias("settlement_cycle")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pay_customer: customers; every tenth dropped."""
    c = table(spark, sf_dir, "customer")
    nr = _nation_region(spark, sf_dir)
    return (c.where(F.col("c_custkey") % 10 != 0)
             .join(nr, c.c_nationkey == nr.n_nationkey)
             .select(F.col("c_custkey").cast("int").alias("customer_id"),
                     F.col("c_name").alias("customer_name"),
                     F.col("c_mktsegment").alias("age_group"),
                     F.col("n_name").alias("city"),
                     F.col("r_name").alias("state"),
                     F.lit("2024-01-01").cast("date").alias("signup_date"),
                     F.when(F.col("c_acctbal") < 0, "PENDING").otherwise("VERIFIED")
                      .alias("kyc_status"),
                     (F.col("c_custkey") % 5 + 1).cast("int").alias("preferred_channel_id")))


#: What a transaction id is made of; one id is one pair.
TXN_KEY = ("l_orderkey", "l_linenumber")


def _transaction_id() -> Column:
    return F.concat(F.lit("TXN"), F.col("l_orderkey").cast("string"), F.lit("-"),
                    F.col("l_linenumber").cast("string")).alias("transaction_id")


def transactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pay_transactions_raw: one row per line item; transaction ids repeat."""
    raw = _line_transactions(spark, sf_dir)
    return raw.select(_transaction_id(), *[c for c in raw.columns if c not in TXN_KEY])


def _line_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``transactions_raw``, ``TXN_KEY`` in the place of the id."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    amount = F.col("l_extendedprice").cast(S.MONEY)
    # Orders get their customer's nation first (an orders-sized join), so the
    # lineitem side is shuffled once, on the order key, not once per join.
    orders_city = (o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                            "o_orderpriority")
                    .join(c, F.col("o_custkey") == c.c_custkey)
                    .join(n, F.col("c_nationkey") == n.n_nationkey))
    j = li.join(orders_city, li.l_orderkey == orders_city.o_orderkey)
    return j.select(
        *TXN_KEY,
        F.col("o_custkey").cast("int").alias("customer_id"),
        F.col("l_suppkey").cast("int").alias("merchant_id"),
        _priority_digit().cast("int").alias("channel_id"),
        F.col("o_orderdate").alias("transaction_timestamp"),
        amount.alias("transaction_amount"),
        F.when(F.col("o_orderstatus") == "P", "FAILED")
         .when((F.col("l_linestatus") == "O") & (F.col("o_orderstatus") == "O"), "PENDING")
         .otherwise("SUCCESS").alias("transaction_status"),
        F.when(F.col("o_orderstatus") == "P", F.lit("BANK_TIMEOUT")).alias("failure_reason"),
        F.col("n_name").alias("city"),
        F.round(amount * F.lit(0.015).cast("decimal(4,3)"), 2).cast(S.FEE)
         .alias("processing_fee"),
        *[F.col(h) for h in TXN_HELPERS],
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pay_transactions: one deterministic survivor per transaction id."""
    return latest_by_key(transactions_raw(spark, sf_dir), "transaction_id",
                         order=TXN_SURVIVOR_ORDER)


def transactions_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pay_transactions restricted to rows with a transaction id: the input of
    the marts and of the refund / settlement projections."""
    raw = transactions_raw(spark, sf_dir).where(F.col("transaction_id").isNotNull())
    return latest_by_key(raw, "transaction_id", order=TXN_SURVIVOR_ORDER)


def transactions_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``transactions_keyed`` for a single use (a file, a cache).

    Grouped by ``TXN_KEY``, which names the same groups as the id: the join has
    already brought an order's lines together, so the rows are shuffled once.  Consumers
    that join on the id take ``transactions_keyed``, which lies by it."""
    raw = _line_transactions(spark, sf_dir).where(F.col("l_orderkey").isNotNull() & F.col("l_linenumber").isNotNull())
    one = latest_by_key(raw, TXN_KEY, order=TXN_SURVIVOR_ORDER)
    return one.select(_transaction_id(), *[c for c in one.columns if c not in TXN_KEY])


def refunds_from(txn: DataFrame) -> DataFrame:
    """pay_refunds, derived from a (deduplicated) transaction fixture."""
    tid = F.col("transaction_id")
    return (txn.where((F.col("l_returnflag") == "R") & (F.col("transaction_status") == "SUCCESS"))
               .select(F.concat(F.lit("REF"), F.substr(tid, F.lit(4))).alias("refund_id"),
                       F.when(F.col("l_tax") > 0.07, F.concat(tid, F.lit("X"))).otherwise(tid)
                        .alias("transaction_id"),
                       "customer_id",
                       F.col("l_shipdate").alias("refund_timestamp"),
                       (F.col("transaction_amount") * F.lit(0.5).cast("decimal(2,1)"))
                        .cast(S.MONEY).alias("refund_amount"),
                       F.when(F.col("l_partkey") % 3 == 0, "DUPLICATE_PAYMENT")
                        .when(F.col("l_partkey") % 3 == 1, "SERVICE_ISSUE")
                        .otherwise("CUSTOMER_CANCELLED").alias("refund_reason"),
                       F.lit("COMPLETED").alias("refund_status")))


def settlements_from(txn: DataFrame) -> DataFrame:
    """pay_settlements, derived from a (deduplicated) transaction fixture."""
    return (txn.where((F.col("transaction_status") == "SUCCESS") & (F.col("l_returnflag") != "R"))
               .select(F.concat(F.lit("SET"), F.substr(F.col("transaction_id"), F.lit(4)))
                        .alias("settlement_id"),
                       "merchant_id", "transaction_id",
                       F.date_add(F.to_date("l_shipdate"), 1).alias("settlement_date"),
                       F.col("transaction_amount").alias("gross_amount"),
                       F.col("processing_fee").cast(S.MONEY).alias("fee_amount"),
                       (F.col("transaction_amount") - F.col("processing_fee")).cast(S.MONEY)
                        .alias("net_amount"),
                       F.when(F.col("l_linestatus") == "O", "PENDING").otherwise("SETTLED")
                        .alias("settlement_status")))


def transactions_clean(txn: DataFrame) -> DataFrame:
    """The transaction fixture in the dataset's own schema (helpers dropped).

    ``device_type`` and ``bank_name`` have no source column: they are null.
    """
    cols = []
    for f in S.TRANSACTIONS.schema.fields:
        if f.name in txn.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return txn.select(*cols)


def file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pay_file_events: ledger events, one per event row, file = user."""
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return e.select(
        "event_id",
        F.concat(F.lit("file_"), F.col("user_id").cast("string"), F.lit(".csv")).alias("file_name"),
        F.col("ts").alias("event_ts"),
        F.when(et == "view", "A").when(et == "purchase", "C").otherwise("F").alias("status"),
        F.when(et == "error", S.ERR_SYSTEM).when(et == "signup", S.ERR_NETWORK)
         .when(et == "click", S.ERR_INVALID_FILE).alias("error_type"),
    )


# File-name stems assigned to event ids (event_id % 8), in order.
FILE_STEMS = ("dim_customer_", "dim_merchant_", "dim_payment_channel_", "fact_refunds_",
              "fact_settlements_", "fact_transactions_", "Fact_Transactions_", "unknown_")


def file_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pay_files: landing paths for the routing / extension / path operators."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id") % 8
    stem = F.lit(FILE_STEMS[-1])
    for i in range(len(FILE_STEMS) - 2, -1, -1):
        stem = F.when(k == i, F.lit(FILE_STEMS[i])).otherwise(stem)
    ext = (F.when(F.col("event_id") % 11 == 0, ".json")
            .when(F.col("event_id") % 5 == 0, ".CSV").otherwise(".csv"))
    return e.select("event_id",
                    F.concat(F.lit("s3a://bucket/landing/"), stem,
                             F.col("event_id").cast("string"), ext).alias("file_path"))


def payment_datasets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six datasets in their own schemas, transactions NOT yet deduplicated."""
    raw = transactions_raw(spark, sf_dir)
    txn = transactions_keyed(spark, sf_dir)
    return {
        "customer": customers(spark, sf_dir),
        "merchant": merchants(spark, sf_dir),
        "channel": channels(spark, sf_dir),
        "transactions": transactions_clean(raw),
        "refunds": refunds_from(txn),
        "settlements": settlements_from(txn),
    }
