"""Join helpers: dimension lookups and fact-to-fact lookups.

Broadcast policy
----------------
A dimension is broadcast explicitly only when its row count is *known* (the
batch job counts the persisted, deduplicated dimensions in one pass) and is
at most ``max_rows``.  Without a known count the join is left to Spark, whose
broadcast decision is itself size-checked: the planner compares the estimated
plan size with ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks the
measured shuffle size with ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
Nothing is broadcast on faith.

Skew
----
Lookups join a many side to a side that is unique on the key.  A hot key on the
many side (one id, or null ids, holding a third of the rows) is handled in two
ways: rows whose key is null cannot match an equi-join and, with
``bypass_nulls``, skip the shuffle entirely; a hot non-null key is split by
AQE's skew-join handling (the unique side holds one row per key, so what gets
replicated to the split tasks is a single row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
# Measured payload bytes; the in-memory hash relation is a small multiple.
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024


def maybe_broadcast(dim: DataFrame, known_rows: int | tuple[int, int] | None,
                    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the size is known and bounded.

    ``known_rows`` is a measured row count, or ``(rows, payload_bytes)`` as
    ``profile.dataset_sizes`` measures them; both must be within the limits.
    """
    if known_rows is None:
        return dim
    rows, size = known_rows if isinstance(known_rows, tuple) else (known_rows, None)
    if rows <= max_rows and (size is None or size <= max_bytes):
        return F.broadcast(dim)
    return dim


def left_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                bypass_nulls: bool = False) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key``, right key dropped.

    Column names of the two sides must be disjoint (callers project and rename
    the lookup side, which also keeps the shuffled rows narrow).  With
    ``bypass_nulls`` the rows whose key is null are padded with nulls without
    taking part in the join; the result is the same as the plain left join.
    """
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"lookup columns clash: {sorted(clash)}")
    cond = F.col(left_key) == F.col(right_key)
    if not bypass_nulls:
        return left.join(right, cond, "left").drop(right_key)
    matched = left.where(F.col(left_key).isNotNull()).join(right, cond, "left").drop(right_key)
    pad = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields
           if f.name != right_key]
    unmatched = left.where(F.col(left_key).isNull()).select("*", *pad)
    return matched.unionByName(unmatched)
