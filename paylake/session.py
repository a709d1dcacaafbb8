"""Session helpers.

The library never owns the session in production: the caller (a cluster job)
passes one in.  ``local_session`` exists for tests and the bench only.
``scratch_dir`` resolves the shared folder the cluster names in
``spark.checkpoint.dir``; a private folder is created only when that setting is
unset (local tests), never on a cluster that already names one.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a cluster job should carry as well; sized for local[8] here, the
# comments say what to use at 100 TB.
DEFAULT_CONF = {
    # ~cores locally; on a cluster AQE coalesces from a high start value
    # (e.g. 4000-8000) down to ~128 MB partitions.
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", app: str = "paylake", extra: dict | None = None,
                  memory: str = "8g") -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    b = b.config("spark.driver.memory", memory)
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; created locally only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:   # Spark Connect: only the SQL conf is visible
        sc = None
    d = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        # unset: local mode only; on a cluster a temporary folder would be one machine's
        if sc is None or not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="paylake-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    # Not created here: Spark writers create it, and an absent folder means
    # "no table yet" to the idempotent sink.
    return f"{root}/paylake/{name}-{uuid.uuid4().hex[:12]}"


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished actions, between the steps of a long job.

    Spark deletes them once the driver's garbage collector finds that nothing refers to them, which
    may be long after: the shuffles of all steps add up on the executors' disks until then."""
    gc.collect()
    try:
        jvm = spark.sparkContext._jvm
    except Exception:   # Spark Connect: the server's driver does it in its own time
        return
    jvm.System.gc()
