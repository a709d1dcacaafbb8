"""Dataset specs of the payments star schema.

Each spec carries the explicit schema used to read the dataset's CSV files,
its primary key, its foreign keys and the file-name token that routes a file
to it.  Money is DECIMAL as the relational DDL declares it (not double), and
timestamps are wall-clock ``TIMESTAMP_NTZ`` because the files carry no zone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
FEE = T.DecimalType(10, 2)
TS = T.TimestampNTZType()


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    token: str
    schema: T.StructType
    pk: str
    fks: tuple[ForeignKey, ...] = field(default_factory=tuple)
    # VARCHAR(n) limits of the relational DDL, checked by the quality operators.
    max_length: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


def _s(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CUSTOMER = DatasetSpec(
    name="customer",
    token="dim_customer",
    schema=_s(("customer_id", T.IntegerType()), ("customer_name", T.StringType()),
              ("age_group", T.StringType()), ("city", T.StringType()),
              ("state", T.StringType()), ("signup_date", T.DateType()),
              ("kyc_status", T.StringType()), ("preferred_channel_id", T.IntegerType())),
    pk="customer_id",
    fks=(ForeignKey("preferred_channel_id", "channel", "channel_id"),),
    max_length={"customer_name": 100, "age_group": 20, "city": 100, "state": 100,
                "kyc_status": 20},
)

MERCHANT = DatasetSpec(
    name="merchant",
    token="dim_merchant",
    schema=_s(("merchant_id", T.IntegerType()), ("merchant_name", T.StringType()),
              ("merchant_category", T.StringType()), ("city", T.StringType()),
              ("state", T.StringType()), ("onboard_date", T.DateType()),
              ("risk_tier", T.StringType()), ("settlement_cycle", T.StringType())),
    pk="merchant_id",
    max_length={"merchant_name": 100, "merchant_category": 50, "city": 100, "state": 100,
                "risk_tier": 20, "settlement_cycle": 20},
)

CHANNEL = DatasetSpec(
    name="channel",
    token="dim_payment_channel",
    schema=_s(("channel_id", T.IntegerType()), ("channel_type", T.StringType()),
              ("provider_name", T.StringType())),
    pk="channel_id",
    max_length={"channel_type": 50, "provider_name": 100},
)

TRANSACTIONS = DatasetSpec(
    name="transactions",
    token="fact_transactions",
    schema=_s(("transaction_id", T.StringType()), ("customer_id", T.IntegerType()),
              ("merchant_id", T.IntegerType()), ("channel_id", T.IntegerType()),
              ("transaction_timestamp", TS), ("transaction_amount", MONEY),
              ("transaction_status", T.StringType()), ("failure_reason", T.StringType()),
              ("device_type", T.StringType()), ("bank_name", T.StringType()),
              ("city", T.StringType()), ("processing_fee", FEE)),
    pk="transaction_id",
    fks=(ForeignKey("customer_id", "customer", "customer_id"),
         ForeignKey("merchant_id", "merchant", "merchant_id"),
         ForeignKey("channel_id", "channel", "channel_id")),
    max_length={"transaction_id": 30, "transaction_status": 20, "failure_reason": 100,
                "device_type": 30, "bank_name": 50, "city": 100},
)

REFUNDS = DatasetSpec(
    name="refunds",
    token="fact_refunds",
    schema=_s(("refund_id", T.StringType()), ("transaction_id", T.StringType()),
              ("customer_id", T.IntegerType()), ("refund_timestamp", TS),
              ("refund_amount", MONEY), ("refund_reason", T.StringType()),
              ("refund_status", T.StringType())),
    pk="refund_id",
    fks=(ForeignKey("transaction_id", "transactions", "transaction_id"),
         ForeignKey("customer_id", "customer", "customer_id")),
    max_length={"refund_id": 30, "transaction_id": 30, "refund_reason": 100,
                "refund_status": 20},
)

SETTLEMENTS = DatasetSpec(
    name="settlements",
    token="fact_settlements",
    schema=_s(("settlement_id", T.StringType()), ("merchant_id", T.IntegerType()),
              ("transaction_id", T.StringType()), ("settlement_date", T.DateType()),
              ("gross_amount", MONEY), ("fee_amount", MONEY), ("net_amount", MONEY),
              ("settlement_status", T.StringType())),
    pk="settlement_id",
    fks=(ForeignKey("merchant_id", "merchant", "merchant_id"),
         ForeignKey("transaction_id", "transactions", "transaction_id")),
    max_length={"settlement_id": 30, "transaction_id": 30, "settlement_status": 20},
)

# Routing order matters: the first token contained in the lower-cased file name
# wins, in this order.
DATASETS: tuple[DatasetSpec, ...] = (CUSTOMER, MERCHANT, CHANNEL, REFUNDS, SETTLEMENTS,
                                     TRANSACTIONS)
BY_NAME = {d.name: d for d in DATASETS}

# Ledger (file status) event schema: one row per state change of a file.
LEDGER_EVENT = T.StructType([
    T.StructField("file_name", T.StringType(), True),
    T.StructField("file_location", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("error_type", T.StringType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("event_ts", TS, True),
    T.StructField("seq", T.LongType(), True),
])

# Ledger states and error types.
STATUS_ACTIVE, STATUS_COMPLETED, STATUS_FAILED = "A", "C", "F"
ERR_INVALID_FILE = "INVALID_FILE"
ERR_SYSTEM = "SYSTEM_FAILURE"
ERR_NETWORK = "NETWORK_FAILURE"
ERR_SCHEMA = "SCHEMA_FAILURE"
ERR_UNKNOWN_DATASET = "UNKNOWN_DATASET"
ERR_MISSING = "FILE_NOT_FOUND"
RETRYABLE_ERRORS = (ERR_SYSTEM, ERR_NETWORK)
MAX_ERROR_MESSAGE = 500
