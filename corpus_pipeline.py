"""A corpus pipeline: toxicity, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet and reads it back as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm import common, minmax_dedup, packing, pii, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _keep(docs: DataFrame, decision: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id ``decision`` (doc_id) lists, and all rows
    without an id, which no decision can name."""
    listed = docs.join(decision.where("doc_id is not null").select(F.col("doc_id").alias("_kept")).distinct(),
                       F.col("doc_id").cast("long") == F.col("_kept"), "left_semi")
    return listed.unionByName(docs.where("doc_id is null"))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are scored toxic go; each row by its own text, whatever its id."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.score_rows(docs, labels, list(COLUMNS)).where("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, and one of rows that
    repeat an id."""
    kept = minmax_dedup.near_duplicates(docs).where("kept")
    named = _keep(docs.select(*COLUMNS).where("doc_id is not null"), kept).dropDuplicates(["doc_id"])
    return named.unionByName(docs.select(*COLUMNS).where("doc_id is null"))


def sanitise_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced in the text."""
    return (pii.sanitise(docs.select(*COLUMNS))
            .withColumn("n_chars", F.length("text").cast("long")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as token pieces, placed in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("pii", sanitise_personal_data),
    ("packing", pack_sequences),
]

#: Segment search, permutations and the genetic algorithm are beyond SQL; the
#: stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  A null text counts as empty and is packed as
    its end token alone; rows without an id stay; of rows that repeat an id, near_dedup
    keeps one; further columns are dropped by the first stage; an empty table gives an
    empty result."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = common.cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
