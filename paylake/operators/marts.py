"""The three denormalised marts.

Inputs are deduplicated datasets (see ``operators.dedup``).  Every join is a
LEFT join, so each mart keeps exactly the rows of its fact table.  The lookup
side of every join is projected to the columns the mart needs and renamed, so
the shuffled / broadcast rows stay narrow and the output needs no aliases.

Each builder takes optional known dimension row counts (``dim_rows``) that
allow an explicit, size-checked broadcast (``joins.maybe_broadcast``) within
``limits`` (rows, payload bytes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_MAX_BROADCAST_BYTES, DEFAULT_MAX_BROADCAST_ROWS, left_lookup, maybe_broadcast

TRANSACTION_MART_COLUMNS = (
    "transaction_id", "customer_id", "merchant_id", "channel_id", "transaction_timestamp",
    "transaction_amount", "transaction_status", "city", "processing_fee", "channel_type",
    "provider_name", "merchant_name", "merchant_category", "state", "risk_tier",
    "settlement_cycle", "transaction_year", "transaction_month")

SETTLEMENT_MART_COLUMNS = (
    "merchant_id", "merchant_name", "merchant_category", "city", "state", "onboard_date",
    "risk_tier", "settlement_cycle", "settlement_id", "settlement_date", "settlement_year",
    "settlement_month", "transaction_id", "gross_amount", "fee_amount", "net_amount",
    "settlement_status", "transaction_timestamp", "transaction_status")

REFUND_MART_COLUMNS = (
    "refund_id", "transaction_id", "customer_id", "refund_timestamp", "refund_amount",
    "refund_reason", "refund_status", "merchant_id", "merchant_name", "merchant_category",
    "age_group", "city", "state", "transaction_amount", "transaction_status",
    "transaction_timestamp", "channel_id", "refund_year", "refund_month")

PARTITION_COLUMNS = {
    "transaction_performance": ("transaction_year", "transaction_month"),
    "merchant_settlement": ("settlement_year", "settlement_month"),
    "refund_insights": ("refund_year", "refund_month"),
}
MART_KEYS = {
    "transaction_performance": "transaction_id",
    "merchant_settlement": "settlement_id",
    "refund_insights": "refund_id",
}

#: Largest dimension that is broadcast, in rows and payload bytes.
LIMITS = (DEFAULT_MAX_BROADCAST_ROWS, DEFAULT_MAX_BROADCAST_BYTES)


def _rows(dim_rows: dict | None, name: str) -> int | None:
    return (dim_rows or {}).get(name)


def transaction_performance(transactions: DataFrame, merchant: DataFrame, channel: DataFrame,
                            dim_rows: dict | None = None,
                            limits: tuple[int, int] = LIMITS) -> DataFrame:
    """transactions LEFT JOIN merchant LEFT JOIN channel; year/month of the timestamp.

    ``city`` is the transaction's city and ``state`` the merchant's, as in the
    original mart.
    """
    m = maybe_broadcast(
        merchant.select(F.col("merchant_id").alias("_m_id"), "merchant_name",
                        "merchant_category", "state", "risk_tier", "settlement_cycle"),
        _rows(dim_rows, "merchant"), *limits)
    c = maybe_broadcast(
        channel.select(F.col("channel_id").alias("_c_id"), "channel_type", "provider_name"),
        _rows(dim_rows, "channel"), *limits)
    t = transactions.select("transaction_id", "customer_id", "merchant_id", "channel_id",
                            "transaction_timestamp", "transaction_amount",
                            "transaction_status", "city", "processing_fee")
    j = left_lookup(left_lookup(t, m, "merchant_id", "_m_id"), c, "channel_id", "_c_id")
    ts = F.col("transaction_timestamp")
    return j.select(*TRANSACTION_MART_COLUMNS[:-2],
                    F.year(ts).alias("transaction_year"), F.month(ts).alias("transaction_month"))


def merchant_settlement(settlements: DataFrame, transactions: DataFrame, merchant: DataFrame,
                        dim_rows: dict | None = None,
                        limits: tuple[int, int] = LIMITS) -> DataFrame:
    """settlements LEFT JOIN transactions LEFT JOIN merchant (on the settlement's merchant).

    ``merchant_id`` is the merchant's, so it is null when the merchant is unknown.
    """
    t = transactions.select(F.col("transaction_id").alias("_t_id"), "transaction_timestamp",
                            "transaction_status")
    m = maybe_broadcast(
        merchant.select(F.col("merchant_id").alias("_m_id"), "merchant_name",
                        "merchant_category", F.col("city").alias("_m_city"),
                        F.col("state").alias("_m_state"), "onboard_date", "risk_tier",
                        "settlement_cycle"),
        _rows(dim_rows, "merchant"), *limits)
    s = settlements.select("settlement_id", F.col("merchant_id").alias("_s_merchant_id"),
                           "transaction_id", "settlement_date", "gross_amount", "fee_amount",
                           "net_amount", "settlement_status")
    j = left_lookup(s, t, "transaction_id", "_t_id", bypass_nulls=True)
    j = j.join(m, F.col("_s_merchant_id") == F.col("_m_id"), "left")
    d = F.col("settlement_date")
    return j.select(F.col("_m_id").alias("merchant_id"), "merchant_name", "merchant_category",
                    F.col("_m_city").alias("city"), F.col("_m_state").alias("state"),
                    "onboard_date", "risk_tier", "settlement_cycle", "settlement_id",
                    "settlement_date", F.year(d).alias("settlement_year"),
                    F.month(d).alias("settlement_month"), "transaction_id", "gross_amount",
                    "fee_amount", "net_amount", "settlement_status", "transaction_timestamp",
                    "transaction_status")


def refund_insights(refunds: DataFrame, transactions: DataFrame, merchant: DataFrame,
                    customer: DataFrame, dim_rows: dict | None = None,
                    limits: tuple[int, int] = LIMITS) -> DataFrame:
    """refunds LEFT JOIN transactions LEFT JOIN merchant LEFT JOIN customer.

    Merchant and customer are found through the *transaction*; ``customer_id``
    in the output is the refund's own.
    """
    t = transactions.select(F.col("transaction_id").alias("_t_id"),
                            F.col("merchant_id").alias("_t_merchant_id"),
                            F.col("customer_id").alias("_t_customer_id"),
                            "transaction_amount", "transaction_status",
                            "transaction_timestamp", "channel_id")
    m = maybe_broadcast(
        merchant.select(F.col("merchant_id").alias("_m_id"), "merchant_name",
                        "merchant_category"),
        _rows(dim_rows, "merchant"), *limits)
    c = maybe_broadcast(
        customer.select(F.col("customer_id").alias("_c_id"), "age_group",
                        F.col("city").alias("_c_city"), F.col("state").alias("_c_state")),
        _rows(dim_rows, "customer"), *limits)
    r = refunds.select("refund_id", "transaction_id", "customer_id", "refund_timestamp",
                       "refund_amount", "refund_reason", "refund_status")
    j = left_lookup(r, t, "transaction_id", "_t_id", bypass_nulls=True)
    j = j.join(m, F.col("_t_merchant_id") == F.col("_m_id"), "left")
    j = j.join(c, F.col("_t_customer_id") == F.col("_c_id"), "left")
    ts = F.col("refund_timestamp")
    return j.select("refund_id", "transaction_id", "customer_id", "refund_timestamp",
                    "refund_amount", "refund_reason", "refund_status",
                    F.col("_m_id").alias("merchant_id"), "merchant_name", "merchant_category",
                    "age_group", F.col("_c_city").alias("city"),
                    F.col("_c_state").alias("state"), "transaction_amount",
                    "transaction_status", "transaction_timestamp", "channel_id",
                    F.year(ts).alias("refund_year"), F.month(ts).alias("refund_month"))
