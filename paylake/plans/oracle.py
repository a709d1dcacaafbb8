"""DuckDB SQL for every query key: the independent oracle of the correctness gate.

Each statement inlines the ``pay_*`` projections it needs as CTEs over the
pre-registered test tables.  Conventions mirror ``operators.kpis``: sums of
DECIMAL money rounded and returned as DOUBLE; ratios in DOUBLE; DuckDB's
BIGINT ``year``/``month`` cast to INTEGER; explicit NULLS FIRST wherever an
order feeds a ``LIMIT`` or a survivor choice.
"""

from __future__ import annotations

CTES: dict[str, str] = {
    "pay_channel": """
select distinct cast(substring(o_orderpriority,1,1) as integer) channel_id,
       substring(o_orderpriority,3) channel_type,
       concat('P',substring(o_orderpriority,1,1)) provider_name
from orders where substring(o_orderpriority,1,1) <> '5'""",
    "pay_merchant": """
select cast(s_suppkey as integer) merchant_id, s_name merchant_name, r_name merchant_category,
       n_name city, r_name state, cast('2023-01-01' as date) onboard_date,
       case when s_acctbal < 3000 then 'LOW' when s_acctbal < 6000 then 'MEDIUM' else 'HIGH' end risk_tier,
       concat('T+',cast(s_suppkey % 3 + 1 as varchar)) settlement_cycle
from supplier join nation on s_nationkey=n_nationkey join region on n_regionkey=r_regionkey
where s_suppkey % 10 <> 0""",
    "pay_customer": """
select cast(c_custkey as integer) customer_id, c_name customer_name, c_mktsegment age_group,
       n_name city, r_name state, cast('2024-01-01' as date) signup_date,
       case when c_acctbal < 0 then 'PENDING' else 'VERIFIED' end kyc_status,
       cast(c_custkey % 5 + 1 as integer) preferred_channel_id
from customer join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey
where c_custkey % 10 <> 0""",
    "pay_transactions_raw": """
select concat('TXN',cast(l_orderkey as varchar),'-',cast(l_linenumber as varchar)) transaction_id,
       cast(o_custkey as integer) customer_id, cast(l_suppkey as integer) merchant_id,
       cast(substring(o_orderpriority,1,1) as integer) channel_id,
       o_orderdate transaction_timestamp,
       cast(l_extendedprice as decimal(12,2)) transaction_amount,
       case when o_orderstatus='P' then 'FAILED'
            when l_linestatus='O' and o_orderstatus='O' then 'PENDING'
            else 'SUCCESS' end transaction_status,
       case when o_orderstatus='P' then 'BANK_TIMEOUT' end failure_reason,
       n_name city,
       cast(round(cast(l_extendedprice as decimal(12,2)) * cast(0.015 as decimal(4,3)),2) as decimal(10,2)) processing_fee,
       l_returnflag, l_linestatus, l_shipdate, l_discount, l_partkey, l_suppkey,
       l_quantity, l_extendedprice, l_tax
from lineitem join orders on l_orderkey=o_orderkey
     join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey""",
    "pay_transactions": """
select * exclude (rn) from (select *, row_number() over (partition by transaction_id
  order by l_shipdate nulls first, l_partkey nulls first, l_suppkey nulls first,
           l_quantity nulls first, l_extendedprice nulls first, l_discount nulls first,
           l_tax nulls first, l_returnflag nulls first, l_linestatus nulls first) rn
  from pay_transactions_raw) q where rn=1""",
    "pay_transactions_keyed": """
select * from pay_transactions where transaction_id is not null""",
    "pay_refunds": """
select concat('REF',substring(transaction_id,4)) refund_id,
       case when l_tax > 0.07 then concat(transaction_id,'X') else transaction_id end transaction_id,
       customer_id, l_shipdate refund_timestamp,
       cast(transaction_amount * cast(0.5 as decimal(2,1)) as decimal(12,2)) refund_amount,
       case when l_partkey % 3 = 0 then 'DUPLICATE_PAYMENT'
            when l_partkey % 3 = 1 then 'SERVICE_ISSUE' else 'CUSTOMER_CANCELLED' end refund_reason,
       'COMPLETED' refund_status
from pay_transactions_keyed where l_returnflag='R' and transaction_status='SUCCESS'""",
    "pay_settlements": """
select concat('SET',substring(transaction_id,4)) settlement_id, merchant_id, transaction_id,
       cast(l_shipdate + interval 1 day as date) settlement_date,
       transaction_amount gross_amount, cast(processing_fee as decimal(12,2)) fee_amount,
       cast(transaction_amount - processing_fee as decimal(12,2)) net_amount,
       case when l_linestatus='O' then 'PENDING' else 'SETTLED' end settlement_status
from pay_transactions_keyed where transaction_status='SUCCESS' and l_returnflag <> 'R'""",
    "pay_file_events": """
select event_id, concat('file_',cast(user_id as varchar),'.csv') file_name, ts event_ts,
       case event_type when 'view' then 'A' when 'purchase' then 'C' else 'F' end status,
       case event_type when 'error' then 'SYSTEM_FAILURE' when 'signup' then 'NETWORK_FAILURE'
                       when 'click' then 'INVALID_FILE' end error_type
from events""",
    "pay_files": """
select event_id, concat('s3a://bucket/landing/',
  case event_id % 8 when 0 then 'dim_customer_' when 1 then 'dim_merchant_'
    when 2 then 'dim_payment_channel_' when 3 then 'fact_refunds_'
    when 4 then 'fact_settlements_' when 5 then 'fact_transactions_'
    when 6 then 'Fact_Transactions_' else 'unknown_' end,
  cast(event_id as varchar),
  case when event_id % 11 = 0 then '.json' when event_id % 5 = 0 then '.CSV' else '.csv' end) file_path
from events""",
    "mart_txn": """
select t.transaction_id, t.customer_id, t.merchant_id, t.channel_id, t.transaction_timestamp,
       t.transaction_amount, t.transaction_status, t.city, t.processing_fee,
       c.channel_type, c.provider_name, m.merchant_name, m.merchant_category, m.state,
       m.risk_tier, m.settlement_cycle,
       cast(year(t.transaction_timestamp) as integer) transaction_year,
       cast(month(t.transaction_timestamp) as integer) transaction_month
from pay_transactions_keyed t
left join pay_merchant m on t.merchant_id = m.merchant_id
left join pay_channel c on t.channel_id = c.channel_id""",
    "mart_stl": """
select m.merchant_id, m.merchant_name, m.merchant_category, m.city, m.state, m.onboard_date,
       m.risk_tier, m.settlement_cycle, s.settlement_id, s.settlement_date,
       cast(year(s.settlement_date) as integer) settlement_year,
       cast(month(s.settlement_date) as integer) settlement_month,
       s.transaction_id, s.gross_amount, s.fee_amount, s.net_amount, s.settlement_status,
       t.transaction_timestamp, t.transaction_status
from pay_settlements s
left join pay_transactions_keyed t on s.transaction_id = t.transaction_id
left join pay_merchant m on s.merchant_id = m.merchant_id""",
    "mart_ref": """
select r.refund_id, r.transaction_id, r.customer_id, r.refund_timestamp, r.refund_amount,
       r.refund_reason, r.refund_status, m.merchant_id, m.merchant_name, m.merchant_category,
       c.age_group, c.city, c.state, t.transaction_amount, t.transaction_status,
       t.transaction_timestamp, t.channel_id,
       cast(year(r.refund_timestamp) as integer) refund_year,
       cast(month(r.refund_timestamp) as integer) refund_month
from pay_refunds r
left join pay_transactions_keyed t on r.transaction_id = t.transaction_id
left join pay_merchant m on m.merchant_id = t.merchant_id
left join pay_customer c on c.customer_id = t.customer_id""",
}

# CTE dependencies, so a statement can name only what it selects from.
DEPS: dict[str, tuple[str, ...]] = {
    "pay_transactions": ("pay_transactions_raw",),
    "pay_transactions_keyed": ("pay_transactions",),
    "pay_refunds": ("pay_transactions_keyed",),
    "pay_settlements": ("pay_transactions_keyed",),
    "mart_txn": ("pay_transactions_keyed", "pay_merchant", "pay_channel"),
    "mart_stl": ("pay_settlements", "pay_transactions_keyed", "pay_merchant"),
    "mart_ref": ("pay_refunds", "pay_transactions_keyed", "pay_merchant", "pay_customer"),
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in DEPS.get(n, ()):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(uses: tuple[str, ...], body: str) -> str:
    names = _closure(uses)
    ctes = ",\n".join(f"{n} as ({CTES[n]}\n)" for n in names)
    return f"with {ctes}\n{body}"


def _money(expr: str) -> str:
    return f"cast(round({expr}, 2) as double)"


def _pct(hits: str, total: str) -> str:
    return f"round(cast({hits} as double) * 100.0 / nullif(cast({total} as double), 0), 2)"


SUCCESS_HITS = "sum(case when transaction_status = 'SUCCESS' then 1 else 0 end)"

SQL: dict[str, str] = {
    # ------------------------------------------------------------- marts
    "mart_transaction_performance": with_ctes(("mart_txn",), "select * from mart_txn"),
    "mart_merchant_settlement": with_ctes(("mart_stl",), "select * from mart_stl"),
    "mart_refund_insights": with_ctes(("mart_ref",), "select * from mart_ref"),
    # ------------------------------------------------------ transaction KPIs
    "kpi_daily_volume": with_ctes(("mart_txn",), """
select strftime(transaction_timestamp, '%Y-%m-%d') "Day",
       count(transaction_id) daily_transaction_volume
from mart_txn group by 1 order by 1"""),
    "kpi_success_rate": with_ctes(("mart_txn",), f"""
select {_pct(SUCCESS_HITS, 'count(*)')} success_rate from mart_txn"""),
    "kpi_channel_revenue": with_ctes(("mart_txn",), f"""
select channel_type, {_money('sum(processing_fee)')} channel_revenue
from mart_txn where transaction_status = 'SUCCESS' group by channel_type
order by channel_revenue desc, channel_type nulls first"""),
    "kpi_city_payments": with_ctes(("mart_txn",), f"""
select city, count(transaction_id) txn_count, {_money('sum(transaction_amount)')} payment_amount,
       round(cast(sum(transaction_amount) as double) / nullif(cast(count(transaction_amount) as double), 0), 2) avg_ticket_size
from mart_txn where transaction_status = 'SUCCESS' group by city
order by payment_amount desc, city nulls first"""),
    "kpi_monthly_channel_success": with_ctes(("mart_txn",), f"""
select strftime(transaction_timestamp, '%Y-%m') "month", channel_type,
       {_pct(SUCCESS_HITS, 'count(*)')} success_rate
from mart_txn group by 1, 2 order by 1, 2"""),
    # ------------------------------------------------------- settlement KPIs
    "kpi_monthly_settled": with_ctes(("mart_stl",), f"""
select strftime(settlement_date, '%Y-%m') "month", {_money('sum(net_amount)')} total_settled_amount
from mart_stl group by 1 order by 1"""),
    "kpi_pending_settlement_pct": with_ctes(("mart_stl",), f"""
select {_pct("sum(case when settlement_status = 'PENDING' then 1 else 0 end)", 'count(*)')} pending_settlement_pct
from mart_stl"""),
    "kpi_merchant_payout": with_ctes(("mart_stl",), f"""
select merchant_id, merchant_name, {_money('sum(net_amount)')} merchant_net_payout
from mart_stl group by merchant_id, merchant_name
order by merchant_net_payout desc, merchant_id nulls first, merchant_name nulls first"""),
    "kpi_category_fee_revenue": with_ctes(("mart_stl",), f"""
select merchant_category, {_money('sum(fee_amount)')} fee_revenue
from mart_stl group by merchant_category order by fee_revenue desc, merchant_category nulls first"""),
    # ---------------------------------------------------------- refund KPIs
    "kpi_refund_rate": with_ctes(("mart_ref", "mart_txn"), """
select a.refund_txn, b.total_success_txn,
       round(cast(a.refund_txn as double) / nullif(cast(b.total_success_txn as double), 0) * 100.0, 2) refund_rate
from (select cast(count(*) as bigint) refund_txn from (select distinct transaction_id from mart_ref)) a,
     (select cast(count(*) as bigint) total_success_txn from mart_txn where transaction_status = 'SUCCESS') b"""),
    "kpi_top_refund_merchants": with_ctes(("mart_ref",), """
select merchant_id, merchant_name, count(refund_id) refund_cnt
from mart_ref group by merchant_id, merchant_name
order by refund_cnt desc, merchant_id nulls first, merchant_name nulls first limit 5"""),
    "kpi_refund_reasons": with_ctes(("mart_ref",), """
select refund_reason, count(refund_id) refund_count
from mart_ref group by refund_reason order by refund_count desc, refund_reason nulls first"""),
    "kpi_repeat_refund_customers": with_ctes(("mart_ref",), """
select customer_id, count(refund_id) refund_cnt
from mart_ref group by customer_id having count(refund_id) > 1
order by refund_cnt desc, customer_id nulls first"""),
    # ----------------------------------------------------------------- dedup
    "ded_latest_by_key": with_ctes(("pay_transactions",), """
select * from pay_transactions"""),
    "ded_drop_duplicates": with_ctes(("pay_transactions_raw",), """
select distinct transaction_id from pay_transactions_raw"""),
}

CTES["pay_transactions_csv"] = """
select transaction_id, customer_id, merchant_id, channel_id, transaction_timestamp,
       transaction_amount, transaction_status, failure_reason,
       cast(null as varchar) device_type, cast(null as varchar) bank_name, city, processing_fee
from pay_transactions_raw"""
DEPS["pay_transactions_csv"] = ("pay_transactions_raw",)

# Datasets of the quality checks: transactions before deduplication.
DATASET_VIEWS = {"customer": "pay_customer", "merchant": "pay_merchant",
                 "channel": "pay_channel", "refunds": "pay_refunds",
                 "settlements": "pay_settlements", "transactions": "pay_transactions_csv"}
PKS = {"customer": "customer_id", "merchant": "merchant_id", "channel": "channel_id",
       "refunds": "refund_id", "settlements": "settlement_id", "transactions": "transaction_id"}
ALL_VIEWS = tuple(DATASET_VIEWS.values())


def _file_name(expr: str) -> str:
    return f"string_split({expr}, '/')[-1]"


# Dataset tokens in routing order.
ROUTES = (("dim_customer", "customer"), ("dim_merchant", "merchant"),
          ("dim_payment_channel", "channel"), ("fact_refunds", "refunds"),
          ("fact_settlements", "settlements"), ("fact_transactions", "transactions"))
_ROUTE_CASE = "case " + " ".join(
    f"when contains(lower({_file_name('file_path')}), '{tok}') then '{name}'"
    for tok, name in ROUTES) + " end"

_LEDGER_CURRENT = """
ledger_current as (
  select file_name, status, error_type, created_date, updated_date, attempts from (
    select file_name, status, error_type,
           row_number() over (partition by file_name order by event_ts desc, event_id desc) rn,
           min(event_ts) over (partition by file_name) created_date,
           max(event_ts) over (partition by file_name) updated_date,
           cast(count(*) filter (where status = 'F') over (partition by file_name) as bigint) attempts
    from pay_file_events) q where rn = 1)"""


def _ledger(body: str) -> str:
    return with_ctes(("pay_file_events",), "").replace(
        "\n", "", 0) + "," + _LEDGER_CURRENT + "\n" + body


def _fk_sql() -> str:
    # The declared foreign keys (child, column, parent, parent column).
    fks = (("customer", "preferred_channel_id", "channel", "channel_id"),
           ("transactions", "customer_id", "customer", "customer_id"),
           ("transactions", "merchant_id", "merchant", "merchant_id"),
           ("transactions", "channel_id", "channel", "channel_id"),
           ("refunds", "transaction_id", "transactions", "transaction_id"),
           ("refunds", "customer_id", "customer", "customer_id"),
           ("settlements", "merchant_id", "merchant", "merchant_id"),
           ("settlements", "transaction_id", "transactions", "transaction_id"))
    parts = []
    for child, col, parent, pcol in fks:
        parts.append(
            f"select '{child}.{col}->{parent}.{pcol}' relation, count(*) orphan_rows "
            f"from {DATASET_VIEWS[child]} c where c.{col} is not null and not exists "
            f"(select 1 from {DATASET_VIEWS[parent]} p where p.{pcol} = c.{col})")
    return with_ctes(ALL_VIEWS, "\nunion all\n".join(parts))


def _domain_sql() -> str:
    from pyspark.sql import types as T

    from .. import schemas as S
    from ..operators.quality import DOMAINS

    parts = []
    for spec in S.DATASETS:
        view = DATASET_VIEWS[spec.name]
        rules = [(spec.pk, "pk_not_null", f"{spec.pk} is null")]
        rules += [(c, f"max_length_{n}", f"length({c}) > {n}") for c, n in spec.max_length.items()]
        rules += [(f.name, f"decimal_{f.dataType.precision}_{f.dataType.scale}",
                   f"abs({f.name}) >= {10 ** (f.dataType.precision - f.dataType.scale)} "
                   f"or {f.name} <> round({f.name}, {f.dataType.scale})")
                  for f in spec.schema.fields if isinstance(f.dataType, T.DecimalType)]
        for c, allowed in DOMAINS.get(spec.name, {}).items():
            lst = ", ".join(f"'{v}'" for v in allowed)
            rules.append((c, "domain", f"{c} is not null and {c} not in ({lst})"))
        for c, r, pred in rules:
            parts.append(f"select '{spec.name}' dataset, '{c}' column_name, '{r}' rule, "
                         f"count(*) filter (where {pred}) violations from {view}")
    return with_ctes(ALL_VIEWS, "\nunion all\n".join(parts))


_PATH_NORM = """
p as (select event_id, trim(file_path) t from pay_files),
n as (select event_id, t,
        case when starts_with(t, 's3a://') then 's3a://' || replace(substr(t, 7), '//', '/')
             when starts_with(t, 's3://') then 's3://' || replace(substr(t, 6), '//', '/') end norm,
        case when starts_with(t, 's3a://') then 's3a://bucket/'
             when starts_with(t, 's3://') then 's3://bucket/' end prefix
      from p),
k as (select event_id, t,
        case when norm is null then null
             when instr(norm, prefix) > 0
             then substr(norm, 1, instr(norm, prefix) - 1) || substr(norm, instr(norm, prefix) + length(prefix))
             else norm end source_key
      from n),
f as (select *, string_split(regexp_replace(source_key, '/+$', ''), '/')[-1] fname from k)"""

SQL.update({
    "src_csv_scan": with_ctes(("pay_transactions_csv",), "select * from pay_transactions_csv"),
    "src_route_files": with_ctes(("pay_files",), f"""
select event_id, file_path, {_file_name('file_path')} file_name, {_ROUTE_CASE} dataset
from pay_files"""),
    "src_multi_file_union": with_ctes(("pay_settlements",), "select * from pay_settlements"),
    "src_list_files": with_ctes(("pay_settlements",), """
select distinct 'drop=' || cast(year(settlement_date) as varchar) parent from pay_settlements"""),
    "src_mart_year_scan": with_ctes(("mart_txn",), """
select * from mart_txn where transaction_year = 1995"""),
    "snk_partitioned_roundtrip": with_ctes(("mart_stl",), "select * from mart_stl"),
    "snk_idempotent_append": with_ctes(("mart_ref",), "select * from mart_ref"),
    "snk_indexed_append": with_ctes(("mart_ref",), "select * from mart_ref"),
    "val_file_extension": with_ctes(("pay_files",), """
select event_id, file_path, suffix(lower(file_path), '.csv') is_valid from pay_files"""),
    "val_missing_columns": """
select * from (values ('dim_customer', '', true), ('dim_merchant', '', true),
  ('dim_payment_channel', '', true), ('fact_refunds', '', true),
  ('fact_settlements', '', true), ('fact_transactions', '', true),
  ('fact_refunds_bad', 'refund_status', false)) v(folder, missing_columns, is_valid)""",
    "path_normalize": with_ctes(("pay_files",), "") + "," + _PATH_NORM + """
select event_id, (starts_with(t, 's3://') or starts_with(t, 's3a://')) is_valid_scheme,
       source_key, fname file_name, 'processing/' || fname destination_key,
       's3a://bucket/processed/' || fname processed_path
from f""",
    "prof_dataset_counts": with_ctes(ALL_VIEWS, "\nunion all\n".join(
        f"select '{name}' dataset, count(*) record_count from (select distinct {PKS[name]} from {view})"
        for name, view in DATASET_VIEWS.items())),
    "dq_pk_duplicates": with_ctes(ALL_VIEWS, "\nunion all\n".join(
        f"select '{name}' dataset, cast({PKS[name]} as varchar) key_value, count(*) n_rows "
        f"from {view} group by {PKS[name]} having count(*) > 1"
        for name, view in DATASET_VIEWS.items())),
    "dq_fk_orphans": _fk_sql(),
    "dq_domain_violations": _domain_sql(),
    "led_current_state": _ledger("select * from ledger_current"),
    "led_retryable": _ledger("""
select file_name, error_type, attempts from ledger_current
where status = 'F' and error_type in ('SYSTEM_FAILURE', 'NETWORK_FAILURE')"""),
    "led_stale_active": _ledger("""
select file_name, 'F' status, 'SYSTEM_FAILURE' error_type,
       'Job terminated unexpectedly' error_message
from ledger_current where status = 'A'"""),
})

SQL.update({
    "stream_ingest_once": with_ctes(("pay_transactions_csv",), "select * from pay_transactions_csv"),
    # First drop (closed lines) wins; inside a drop the smallest row by
    # (timestamp, then every other column in schema order) survives.
    "stream_dedup": with_ctes(("pay_transactions_raw",), """
select transaction_id, customer_id, merchant_id, channel_id, transaction_timestamp,
       transaction_amount, transaction_status, failure_reason, device_type, bank_name, city,
       processing_fee
from (select *, cast(null as varchar) device_type, cast(null as varchar) bank_name,
        row_number() over (partition by transaction_id order by
          case when l_linestatus = 'F' then 0 else 1 end, transaction_timestamp nulls first,
          customer_id nulls first, merchant_id nulls first, channel_id nulls first,
          transaction_amount nulls first, transaction_status nulls first,
          failure_reason nulls first, city nulls first, processing_fee nulls first) rn
      from pay_transactions_raw) q
where rn = 1"""),
})

# The batch job's written KPI equals the KPI over the oracle mart.
SQL["job_run_batch"] = SQL["kpi_monthly_channel_success"]
# Over two batches, each refund finds its transaction whenever it comes.
SQL["job_late_transactions"] = SQL["mart_refund_insights"]
SQL["job_late_dimensions"] = SQL["mart_refund_insights"]
SQL["job_fact_update"] = SQL["mart_refund_insights"]
SQL["stream_marts"] = SQL["mart_refund_insights"]
SQL["stream_watermark"] = with_ctes(("pay_transactions",), """
select transaction_id, transaction_timestamp, transaction_amount
from pay_transactions where transaction_id is not null and transaction_timestamp is not null
union all
select transaction_id, transaction_timestamp + interval 4 year, transaction_amount
from pay_transactions where transaction_id is not null
  and year(transaction_timestamp) + 4 <= (select max(year(transaction_timestamp)) from pay_transactions)""")
