"""Optional JDBC access for a ledger kept in an external database.

The library's own ledger is a Parquet event table (``operators.ledger``); a
deployment that must keep the status table in a relational database can read
and append the same events through Spark's JDBC source.  Connection settings
come from the caller (never hard-coded); the driver jar must be on the
classpath.  Reads are split over ``num_partitions`` ranges of a numeric column
when one is given, so a large table is not read by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as S


def read_table(spark: SparkSession, url: str, table: str, properties: dict,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions,
                               properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def append_ledger_events(events: DataFrame, url: str, table: str, properties: dict) -> None:
    """Append ledger events (``schemas.LEDGER_EVENT`` columns) to a database table."""
    events.select(*S.LEDGER_EVENT.fieldNames()).write.jdbc(url, table, mode="append",
                                                           properties=properties)
