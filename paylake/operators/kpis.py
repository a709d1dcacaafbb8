"""The thirteen KPIs over the marts, as lazy ``DataFrame -> DataFrame`` functions.

Conventions
-----------
* Money stays DECIMAL inside the sums (exact); the rounded result is returned
  as DOUBLE.  Ratios and averages are computed in DOUBLE from exact integer /
  decimal sums and rounded to 2 places (``round`` is HALF_UP).
* A ratio over an empty input is null (``try_divide``), never an error.
* Orders are total: measure descending, then the group key ascending with
  nulls first, so ``limit`` never depends on task timing.
* All aggregates are plain hash aggregates with a partial (map-side) stage, so
  a hot group costs one row per task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUCCESS = "SUCCESS"
PENDING = "PENDING"


def _money(total: Column) -> Column:
    return F.round(total, 2).cast("double")


def _pct(hits: Column, total: Column) -> Column:
    """round(100 * hits / total, 2); null when total is 0 or null."""
    return F.round(F.try_divide(hits.cast("double") * F.lit(100.0), total.cast("double")), 2)


def _count_when(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0))


# ---------------------------------------------------------------- transactions

def daily_volume(txn_mart: DataFrame) -> DataFrame:
    """T1: transactions per calendar day (``Day`` = yyyy-MM-dd)."""
    return (txn_mart.groupBy(F.date_format("transaction_timestamp", "yyyy-MM-dd").alias("Day"))
                    .agg(F.count("transaction_id").alias("daily_transaction_volume"))
                    .orderBy(F.col("Day").asc_nulls_first()))


def success_rate(txn_mart: DataFrame) -> DataFrame:
    """T2: share of SUCCESS among all transactions, in percent."""
    return txn_mart.agg(
        _pct(_count_when(F.col("transaction_status") == SUCCESS), F.count(F.lit(1)))
        .alias("success_rate"))


def channel_revenue(txn_mart: DataFrame) -> DataFrame:
    """T3: processing-fee revenue of successful transactions per channel type."""
    return (txn_mart.where(F.col("transaction_status") == SUCCESS)
                    .groupBy("channel_type")
                    .agg(_money(F.sum("processing_fee")).alias("channel_revenue"))
                    .orderBy(F.col("channel_revenue").desc_nulls_last(),
                             F.col("channel_type").asc_nulls_first()))


def city_payments(txn_mart: DataFrame) -> DataFrame:
    """T4: successful payments per city: count, amount, average ticket size."""
    amt = F.col("transaction_amount")
    return (txn_mart.where(F.col("transaction_status") == SUCCESS)
                    .groupBy("city")
                    .agg(F.count("transaction_id").alias("txn_count"),
                         _money(F.sum(amt)).alias("payment_amount"),
                         F.round(F.try_divide(F.sum(amt).cast("double"),
                                              F.count(amt).cast("double")), 2)
                          .alias("avg_ticket_size"))
                    .orderBy(F.col("payment_amount").desc_nulls_last(),
                             F.col("city").asc_nulls_first()))


def monthly_channel_success(txn_mart: DataFrame) -> DataFrame:
    """T5: success rate per (yyyy-MM, channel type)."""
    return (txn_mart.groupBy(F.date_format("transaction_timestamp", "yyyy-MM").alias("month"),
                             "channel_type")
                    .agg(_pct(_count_when(F.col("transaction_status") == SUCCESS),
                              F.count(F.lit(1))).alias("success_rate"))
                    .orderBy(F.col("month").asc_nulls_first(),
                             F.col("channel_type").asc_nulls_first()))


# ----------------------------------------------------------------- settlements

def monthly_settled(stl_mart: DataFrame, settled_only: bool = False) -> DataFrame:
    """S1: net amount per settlement month.

    Like the original KPI it sums every status (PENDING included) unless
    ``settled_only`` is set.
    """
    src = stl_mart.where(F.col("settlement_status") == "SETTLED") if settled_only else stl_mart
    return (src.groupBy(F.date_format("settlement_date", "yyyy-MM").alias("month"))
               .agg(_money(F.sum("net_amount")).alias("total_settled_amount"))
               .orderBy(F.col("month").asc_nulls_first()))


def pending_settlement_pct(stl_mart: DataFrame) -> DataFrame:
    """S2: share of PENDING settlements, in percent."""
    return stl_mart.agg(
        _pct(_count_when(F.col("settlement_status") == PENDING), F.count(F.lit(1)))
        .alias("pending_settlement_pct"))


def merchant_payout(stl_mart: DataFrame, n: int | None = None) -> DataFrame:
    """S3: net payout per merchant, largest first; all merchants unless ``n``."""
    out = (stl_mart.groupBy("merchant_id", "merchant_name")
                   .agg(_money(F.sum("net_amount")).alias("merchant_net_payout"))
                   .orderBy(F.col("merchant_net_payout").desc_nulls_last(),
                            F.col("merchant_id").asc_nulls_first(),
                            F.col("merchant_name").asc_nulls_first()))
    return out.limit(n) if n is not None else out


def category_fee_revenue(stl_mart: DataFrame) -> DataFrame:
    """S4: fee revenue per merchant category."""
    return (stl_mart.groupBy("merchant_category")
                    .agg(_money(F.sum("fee_amount")).alias("fee_revenue"))
                    .orderBy(F.col("fee_revenue").desc_nulls_last(),
                             F.col("merchant_category").asc_nulls_first()))


# --------------------------------------------------------------------- refunds

def refund_rate(refund_mart: DataFrame, txn_mart: DataFrame) -> DataFrame:
    """R1: distinct refunded transaction ids per successful transaction, in percent.

    One plan: each side is reduced to a single row by its own aggregate (the
    transaction side is a plain partial count; only refund ids go through the
    distinct aggregation), the two rows are unioned and folded into one (no
    join, no driver-side arithmetic).  A null refunded id counts as one value,
    as a ``select(...).distinct().count()`` would count it.
    """
    rid = F.col("transaction_id")
    refunded = F.count_distinct(rid) + F.max(F.when(rid.isNull(), 1).otherwise(0))
    r = refund_mart.agg(F.coalesce(refunded, F.lit(0)).cast("long").alias("refund_txn"),
                        F.lit(None).cast("long").alias("total_success_txn"))
    t = (txn_mart.where(F.col("transaction_status") == SUCCESS)
                 .agg(F.lit(None).cast("long").alias("refund_txn"),
                      F.count(F.lit(1)).cast("long").alias("total_success_txn")))
    agg = r.unionByName(t).agg(F.max("refund_txn").alias("refund_txn"),
                               F.max("total_success_txn").alias("total_success_txn"))
    return agg.select("refund_txn", "total_success_txn",
                      F.round(F.try_divide(F.col("refund_txn").cast("double"),
                                           F.col("total_success_txn").cast("double"))
                              * F.lit(100.0), 2).alias("refund_rate"))


def top_refund_merchants(refund_mart: DataFrame, n: int = 5) -> DataFrame:
    """R2: the ``n`` merchants with most refunds."""
    return (refund_mart.groupBy("merchant_id", "merchant_name")
                       .agg(F.count("refund_id").alias("refund_cnt"))
                       .orderBy(F.col("refund_cnt").desc_nulls_last(),
                                F.col("merchant_id").asc_nulls_first(),
                                F.col("merchant_name").asc_nulls_first())
                       .limit(n))


def refund_reasons(refund_mart: DataFrame) -> DataFrame:
    """R3: refunds per reason."""
    return (refund_mart.groupBy("refund_reason")
                       .agg(F.count("refund_id").alias("refund_count"))
                       .orderBy(F.col("refund_count").desc_nulls_last(),
                                F.col("refund_reason").asc_nulls_first()))


def repeat_refund_customers(refund_mart: DataFrame, min_refunds: int = 2) -> DataFrame:
    """R4: customers with more than one refund."""
    return (refund_mart.groupBy("customer_id")
                       .agg(F.count("refund_id").alias("refund_cnt"))
                       .where(F.col("refund_cnt") >= min_refunds)
                       .orderBy(F.col("refund_cnt").desc_nulls_last(),
                                F.col("customer_id").asc_nulls_first()))


# --------------------------------------------------------------------- bundles

def transaction_kpis(txn_mart: DataFrame) -> dict[str, DataFrame]:
    return {"daily_volume": daily_volume(txn_mart),
            "success_rate": success_rate(txn_mart),
            "channel_revenue": channel_revenue(txn_mart),
            "city_payments": city_payments(txn_mart),
            "monthly_channel_success": monthly_channel_success(txn_mart)}


def settlement_kpis(stl_mart: DataFrame) -> dict[str, DataFrame]:
    return {"monthly_settled": monthly_settled(stl_mart),
            "pending_settlement_pct": pending_settlement_pct(stl_mart),
            "merchant_payout": merchant_payout(stl_mart),
            "category_fee_revenue": category_fee_revenue(stl_mart)}


def refund_kpis(refund_mart: DataFrame, txn_mart: DataFrame) -> dict[str, DataFrame]:
    return {"refund_rate": refund_rate(refund_mart, txn_mart),
            "top_refund_merchants": top_refund_merchants(refund_mart),
            "refund_reasons": refund_reasons(refund_mart),
            "repeat_refund_customers": repeat_refund_customers(refund_mart)}


# ------------------------------------------------------- single-pass variants
#
# The five transaction KPIs read the same mart.  Instead of five scans, one
# partial-aggregated pass builds a summary keyed by (day, channel type, city,
# status) whose size is bounded by those cardinalities, not by the data; every
# KPI is then an exact re-aggregation of the summary (decimal sums and counts
# are associative).

def transaction_summary(txn_mart: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """``extra_keys`` (e.g. the mart's year/month partition columns) are carried
    so the summary can be maintained per partition."""
    amt, fee = F.col("transaction_amount"), F.col("processing_fee")
    return (txn_mart.groupBy(*extra_keys,
                             F.date_format("transaction_timestamp", "yyyy-MM-dd").alias("Day"),
                             "channel_type", "city", "transaction_status")
                    .agg(F.count(F.lit(1)).alias("n_rows"),
                         F.count("transaction_id").alias("n_ids"),
                         F.sum(amt).alias("amount_sum"), F.count(amt).alias("amount_n"),
                         F.sum(fee).alias("fee_sum")))


def transaction_kpis_from_summary(summary: DataFrame) -> dict[str, DataFrame]:
    ok = F.col("transaction_status") == SUCCESS
    succ = summary.where(ok)
    month = F.substr(F.col("Day"), F.lit(1), F.lit(7))
    hits = F.sum(F.when(ok, F.col("n_rows")).otherwise(0))
    return {
        "daily_volume": (summary.groupBy("Day")
                                .agg(F.sum("n_ids").alias("daily_transaction_volume"))
                                .orderBy(F.col("Day").asc_nulls_first())),
        "success_rate": summary.agg(_pct(hits, F.sum("n_rows")).alias("success_rate")),
        "channel_revenue": (succ.groupBy("channel_type")
                                .agg(_money(F.sum("fee_sum")).alias("channel_revenue"))
                                .orderBy(F.col("channel_revenue").desc_nulls_last(),
                                         F.col("channel_type").asc_nulls_first())),
        "city_payments": (succ.groupBy("city")
                              .agg(F.sum("n_ids").alias("txn_count"),
                                   _money(F.sum("amount_sum")).alias("payment_amount"),
                                   F.round(F.try_divide(F.sum("amount_sum").cast("double"),
                                                        F.sum("amount_n").cast("double")), 2)
                                    .alias("avg_ticket_size"))
                              .orderBy(F.col("payment_amount").desc_nulls_last(),
                                       F.col("city").asc_nulls_first())),
        "monthly_channel_success": (summary.groupBy(month.alias("month"), "channel_type")
                                           .agg(_pct(hits, F.sum("n_rows")).alias("success_rate"))
                                           .orderBy(F.col("month").asc_nulls_first(),
                                                    F.col("channel_type").asc_nulls_first())),
    }


# The four settlement KPIs from one summary keyed by (month, merchant,
# category, status); exact for the same reason.

def settlement_summary(stl_mart: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    return (stl_mart.groupBy(*extra_keys,
                             F.date_format("settlement_date", "yyyy-MM").alias("month"),
                             "merchant_id", "merchant_name", "merchant_category",
                             "settlement_status")
                    .agg(F.count(F.lit(1)).alias("n_rows"),
                         F.sum("net_amount").alias("net_sum"),
                         F.sum("fee_amount").alias("fee_sum")))


def settlement_kpis_from_summary(summary: DataFrame) -> dict[str, DataFrame]:
    pending = F.sum(F.when(F.col("settlement_status") == PENDING, F.col("n_rows")).otherwise(0))
    return {
        "monthly_settled": (summary.groupBy("month")
                                   .agg(_money(F.sum("net_sum")).alias("total_settled_amount"))
                                   .orderBy(F.col("month").asc_nulls_first())),
        "pending_settlement_pct": summary.agg(
            _pct(pending, F.sum("n_rows")).alias("pending_settlement_pct")),
        "merchant_payout": (summary.groupBy("merchant_id", "merchant_name")
                                   .agg(_money(F.sum("net_sum")).alias("merchant_net_payout"))
                                   .orderBy(F.col("merchant_net_payout").desc_nulls_last(),
                                            F.col("merchant_id").asc_nulls_first(),
                                            F.col("merchant_name").asc_nulls_first())),
        "category_fee_revenue": (summary.groupBy("merchant_category")
                                        .agg(_money(F.sum("fee_sum")).alias("fee_revenue"))
                                        .orderBy(F.col("fee_revenue").desc_nulls_last(),
                                                 F.col("merchant_category").asc_nulls_first())),
    }


# The refund KPIs from one summary: counts by (month, merchant), (month, reason) and
# (month, customer) in one pass (grouping sets).  The distinct count of refunded
# transactions does not add up over months; it comes from ``plans.refunded``.

def refund_summary(refund_mart: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    keys = ("merchant_id", "merchant_name", "refund_reason", "customer_id")
    sets = [[*extra_keys, "merchant_id", "merchant_name"], [*extra_keys, "refund_reason"],
            [*extra_keys, "customer_id"]]
    by = (F.when(F.grouping("customer_id") == 0, "customer")
          .when(F.grouping("refund_reason") == 0, "reason").otherwise("merchant"))
    return (refund_mart.select(*extra_keys, *keys, "refund_id").groupingSets(sets, *extra_keys, *keys)
                       .agg(by.alias("counted_by"), F.count("refund_id").alias("n_ids")))


def refund_kpis_from_summary(summary: DataFrame, refunded: DataFrame, txn_summary: DataFrame,
                             n: int = 5, min_refunds: int = 2) -> dict[str, DataFrame]:
    """``refunded``: one row with ``refund_txn``; ``txn_summary``: of ``transaction_summary``."""
    success = (txn_summary.where(F.col("transaction_status") == SUCCESS)
               .agg(F.lit(None).cast("long").alias("refund_txn"),
                    F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("total_success_txn")))
    both = (refunded.select("refund_txn", F.lit(None).cast("long").alias("total_success_txn")).unionByName(success)
            .agg(F.max("refund_txn").alias("refund_txn"), F.max("total_success_txn").alias("total_success_txn")))

    def counted(by: str, name: str, *cols: str) -> DataFrame:
        return (summary.where(F.col("counted_by") == by).groupBy(*cols).agg(F.sum("n_ids").alias(name))
                       .orderBy(F.col(name).desc_nulls_last(), *(F.col(c).asc_nulls_first() for c in cols)))

    return {
        "refund_rate": both.select(
            "refund_txn", "total_success_txn",
            F.round(F.try_divide(F.col("refund_txn").cast("double"), F.col("total_success_txn").cast("double"))
                    * F.lit(100.0), 2).alias("refund_rate")),
        "top_refund_merchants": counted("merchant", "refund_cnt", "merchant_id", "merchant_name").limit(n),
        "refund_reasons": counted("reason", "refund_count", "refund_reason"),
        "repeat_refund_customers": counted("customer", "refund_cnt", "customer_id")
        .where(F.col("refund_cnt") >= min_refunds),
    }
