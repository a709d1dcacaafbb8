"""Small helpers shared by the corpus operators.

Conventions that hold for every operator of the subpackage:

* a null text counts as the empty text; a row whose id is null is kept in the
  result with a null id and is never linked to another row;
* only the columns an operator names are read, so further columns of its input,
  whatever they are called, never clash with the columns it adds;
* a table that is cut out of the lineage is written below the folder that the
  session names in ``spark.checkpoint.dir`` and read back, so that a lost
  executor costs a re-read and not a recomputation.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (once a session)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(package)
    target = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, package)))
    sc.addPyFile(target)
    # few rows of very long texts make an Arrow batch, however many rows of short ones
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    _SHIPPED.add(sc.applicationId)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder.

    Without ``spark.checkpoint.dir`` a folder is made only for a local master;
    on a cluster that would be one machine's disk, so it is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns every text operator reads, null texts as empty ones."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def row_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
               limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most ``limit`` bytes of ``column``
    (one row at least), so that Python lists of their values stay small.  What
    Arrow keeps of batches that are done with goes back to the system: two workers
    share an executor's memory with the JVM, and they live on from stage to stage."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)
        del batch, sizes
        pa.default_memory_pool().release_unused()


def table_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch of ``schema`` from plain lists or arrays."""
    return pa.RecordBatch.from_arrays(
        [columns[f.name] if isinstance(columns[f.name], pa.Array)
         else pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
