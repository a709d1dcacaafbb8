"""Streams from the landing folders up to the marts.

Two hops, each with its own checkpoint, each run as often as wished (``availableNow``):

``ingest_checked``  a landing folder -> the base table of its dataset.  A file is taken
                    whole by one micro-batch, so its header is checked before any row is
                    parsed; a file whose header is not exactly its dataset's columns is
                    quarantined (its lines) and ledgered as failed.
``run_mart``        base tables -> a mart.  Refunds and settlements are joined with the
                    transactions by a stream-stream outer join: a fact waits in state for its
                    transaction, and goes out alone once the watermark says that it no longer comes.
``catch_up``        facts that the stream will not give any more (their time lay behind the
                    watermark when they came, or is null), and at ``close`` those that still
                    wait, are built from the base tables.

A micro-batch is staged before it is used, and all appends go by key (``sinks.keyindex``), so one
that is replayed after a crash adds nothing twice.  The join state holds the facts and transactions of the
last ``wait + delay`` of event time, in Spark's RocksDB state store (``streaming.state``; unless the
session names another than the default one), so that it lies on disk and not in the executors' heaps.
A fact that went out alone looks its transaction up in the base table first, so
nothing depends on how far two times lie apart; a transaction that comes later still
is left to the batch job's repair.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass
from functools import partial
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..functions.paths import file_name
from ..operators import ledger, marts
from ..operators.dedup import latest_by_key
from ..operators.quality import split_quarantine
from ..plans.batch import BASE_PARTS, FACT_EVENT_COLUMN, MART_FACTS
from ..plans.together import together
from ..schemas import DatasetSpec
from ..sinks.keyindex import indexed_append, unknown_rows
from ..sinks.parquet import read_existing, write
from ..sources import csv as csvsrc
from .ingest import CSV_GLOB
from .state import DEFAULT_STORE, STATE_STORE, state_on_disk  # noqa: F401

#: Streams may run side by side; their ledger is one table and has one writer at a time.
_LEDGER = Lock()

#: (facts, transactions) -> mart rows, the dimensions bound.
Build = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class StreamConfig:
    """Folders of the streams and their times.  ``wait``: how far a fact's time and its
    transaction's may lie apart for the join; ``delay``: how late rows may come."""

    warehouse: str
    ledger: str
    delay: str = "7 days"
    wait: str = "90 days"

    def base(self, dataset: str) -> str:
        return f"{self.warehouse}/base/{dataset}"

    def mart(self, kind: str) -> str:
        return f"{self.warehouse}/marts/{kind}"

    def work(self, name: str) -> str:
        return f"{self.warehouse}/_stream/{name}"


def header_is(header: Column, columns: Sequence[str]) -> Column:
    """Whether a header line names exactly these columns, in this order."""
    names = F.transform(F.split(header, ","), lambda c: F.regexp_replace(F.trim(c), '^"|"$', ""))
    return names == F.array(*[F.lit(c) for c in columns])


def _available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str,
               stateful: bool = False) -> StreamingQuery:
    write_ = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    with state_on_disk(stream.sparkSession) if stateful else nullcontext():
        q = write_.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def _stored(df: DataFrame, path: str) -> DataFrame:
    write(df, path, mode="overwrite")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ingest_checked(spark: SparkSession, landing: str, spec: DatasetSpec, cfg: StreamConfig,
                   max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Takes the new files of a fact's landing folder into its base table.

    Latest file's row within a micro-batch, first row across them.  Rows that did not
    parse or have no key go to ``quarantine/<dataset>``, the lines of files with another header to
    ``quarantine/<dataset>_files``, one folder a micro-batch, which a replay overwrites."""
    reader = spark.readStream.format("text").option("pathGlobFilter", CSV_GLOB)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(landing).select(
        csvsrc.listed_path(F.col("_metadata.file_path")).alias(csvsrc.SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias(csvsrc.SOURCE_MTIME),
        F.col("_metadata.file_block_start").alias(csvsrc.BLOCK), "value")
    work, event = cfg.work(f"ingest_{spec.name}"), F.col(FACT_EVENT_COLUMN[spec.name])

    def each(batch: DataFrame, batch_id: int) -> None:
        staged = _stored(batch.withColumn(csvsrc.LINE_ID, F.monotonically_increasing_id()), f"{work}/lines/{batch_id}")
        heads = _stored(csvsrc.file_headers(staged).withColumn("ok", F.coalesce(
            header_is(F.col("header"), spec.columns), F.lit(False))), f"{work}/headers/{batch_id}")
        files = heads.select(F.col("file_path").alias("path"), file_name("file_path").alias("file_name"), "ok", "header")
        _mark(files, S.STATUS_ACTIVE, cfg)
        try:
            at = heads.select(F.col("file_path").alias(csvsrc.SOURCE_FILE), "header_line", "ok")
            known = staged.join(at, csvsrc.SOURCE_FILE)
            rows = known.where(F.col("ok") & (F.col(csvsrc.LINE_ID) != F.col("header_line")))
            good, bad = split_quarantine(csvsrc.parse_lines(rows, spec.schema), spec.pk)
            latest = latest_by_key(good, spec.pk, order=(csvsrc.SOURCE_MTIME,), descending=True)
            kept = _stored(latest.select(*spec.columns, F.year(event).alias(BASE_PARTS[0]),
                                         F.month(event).alias(BASE_PARTS[1])), f"{work}/rows/{batch_id}")
            refused = known.where(~F.col("ok")).select(csvsrc.SOURCE_FILE, csvsrc.SOURCE_MTIME, "value")
            together(spark, [
                partial(indexed_append, kept, cfg.base(spec.name), spec.pk, BASE_PARTS),
                partial(write, bad, f"{cfg.warehouse}/quarantine/{spec.name}/_batch={batch_id}", mode="overwrite"),
                partial(write, refused, f"{cfg.warehouse}/quarantine/{spec.name}_files/_batch={batch_id}",
                        mode="overwrite")])
        except Exception as e:
            _mark(files, S.STATUS_FAILED, cfg, error_type=S.ERR_SYSTEM, error_message=str(e))
            raise
        _mark(files.where("ok"), S.STATUS_COMPLETED, cfg)
        _mark(files.where("not ok"), S.STATUS_FAILED, cfg, error_type=S.ERR_SCHEMA,
              error_message=F.concat(F.lit("header mismatch: "), "header"))

    return _available(lines, each, f"{work}/checkpoint")


def _mark(files: DataFrame, status: str, cfg: StreamConfig, **kw) -> None:
    events = ledger.events_for(files, status, location_col="path", seq=time.time_ns() // 1000, **kw)
    with _LEDGER:
        write(events.select(*S.LEDGER_EVENT.fieldNames()), cfg.ledger)


def _base_stream(spark: SparkSession, cfg: StreamConfig, spec: DatasetSpec) -> DataFrame:
    return spark.readStream.schema(spec.schema).parquet(cfg.base(spec.name))


def run_mart(spark: SparkSession, kind: str, build: Build, cfg: StreamConfig) -> StreamingQuery:
    """Takes what is new in the base tables into the mart ``kind``."""
    spec, work = S.BY_NAME[MART_FACTS[kind]], cfg.work(kind)
    facts = _base_stream(spark, cfg, spec).select(
        F.struct(*spec.columns).alias("_f"), F.col("transaction_id").alias("_id"),
        F.col(FACT_EVENT_COLUMN[spec.name]).cast("timestamp").alias("_at"))
    if kind == "transaction_performance":  # nothing to wait for
        ready = facts.withColumn("_t", F.col("_f"))
    else:
        txn = S.TRANSACTIONS
        came = _base_stream(spark, cfg, txn).select(
            F.struct(*txn.columns).alias("_t"), F.col("transaction_id").alias("_t_id"),
            F.col(FACT_EVENT_COLUMN[txn.name]).cast("timestamp").alias("_t_at")).withWatermark("_t_at", cfg.delay)
        wait = F.expr(f"interval {cfg.wait}")
        near = F.col("_t_at").between(F.col("_at") - wait, F.col("_at") + wait)
        ready = facts.withWatermark("_at", cfg.delay).join(came, (F.col("_id") == F.col("_t_id")) & near, "leftOuter")

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = _stored(batch.select("_f", "_t"), f"{work}/ready/{batch_id}")
        alone = rows.where("_t is null and _f.transaction_id is not null")
        with_it = latest_by_key(rows.where("_t is not null").select("_t.*"), "transaction_id")
        if not alone.isEmpty():
            ids = alone.select(F.col("_f.transaction_id").alias("transaction_id"))
            found = _transactions(batch.sparkSession, cfg).join(ids, "transaction_id", "left_semi")
            with_it = latest_by_key(with_it.unionByName(found), "transaction_id")
        _append(kind, build(rows.select("_f.*"), with_it), cfg, f"{work}/built/{batch_id}")

    return _available(ready, each, f"{work}/checkpoint", stateful=True)


def _transactions(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    return spark.read.parquet(cfg.base(S.TRANSACTIONS.name)).select(*S.TRANSACTIONS.columns)


def _append(kind: str, rows: DataFrame, cfg: StreamConfig, stage: str) -> None:
    indexed_append(_stored(rows, stage), cfg.mart(kind), marts.MART_KEYS[kind], marts.PARTITION_COLUMNS[kind])


def catch_up(spark: SparkSession, kind: str, build: Build, cfg: StreamConfig, close: bool = False) -> None:
    """Builds the facts that the mart lacks and the stream will not give: those whose
    time the watermark has left behind, or is null; with ``close`` all that still wait.

    To be called between runs of ``run_mart``, not beside one."""
    spec = S.BY_NAME[MART_FACTS[kind]]
    facts, event = read_existing(spark, cfg.base(spec.name)), F.col(FACT_EVENT_COLUMN[spec.name]).cast(S.TS)
    if facts is None:
        return
    if not close:
        past = []
        for s in {spec.name, S.TRANSACTIONS.name}:
            times = read_existing(spark, cfg.base(s))
            newest = None if times is None else times.agg(F.max(F.col(FACT_EVENT_COLUMN[s]).cast(S.TS))).first()[0]
            if newest is None:
                return  # one side has no time yet: the watermark has not started
            past.append(newest)
        lag = F.expr(f"interval {cfg.delay}") + F.expr(f"interval {cfg.wait}")
        facts = facts.where(event.isNull() | (event < F.lit(min(past)).cast(S.TS) - lag))
    keyed = facts.withColumnsRenamed(dict(zip(BASE_PARTS, marts.PARTITION_COLUMNS[kind])))
    lacking = unknown_rows(keyed, cfg.mart(kind), marts.MART_KEYS[kind], marts.PARTITION_COLUMNS[kind])
    _append(kind, build(lacking.select(*spec.columns), _transactions(spark, cfg)), cfg, f"{cfg.work(kind)}/caught_up")
