"""Deduplication on a business key.

``drop_duplicates``  keeps an arbitrary row per key (the plain behaviour).
``latest_by_key``    keeps a deterministic survivor: the first row by an
                     explicit order, ties broken by every remaining column.

``latest_of_repeated``  the rows of ``latest_by_key``, where only rows whose key may repeat are
                     moved (for a stored table of wide rows).

``latest_by_key`` is an aggregate (``min`` of a struct), not a window: the
partial aggregate collapses duplicates inside each task before the shuffle, so
a key that holds a third of all rows arrives at its reducer as one row per
input task instead of a third of the table (a ``row_number`` window would ship
and sort every row of the hot key in one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


HASH = "_hash"


def _as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def drop_duplicates(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row per key, survivor unspecified."""
    return df.dropDuplicates(_as_list(keys))


def latest_by_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[str] = (),
                  descending: bool = False) -> DataFrame:
    """One row per key: the first by ``order`` (ascending, nulls first), then by
    all other columns, so the survivor never depends on task scheduling.

    With ``descending=True`` the last row by that order survives instead.
    Rows whose key is null form one group, as in SQL ``GROUP BY``.
    """
    keys = _as_list(keys)
    order = list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_row")
    pick = F.max if descending else F.min
    out = df.groupBy(*keys).agg(pick(packed).alias("_row"))
    return out.select(*[F.col(k) if k in keys else F.col(f"_row.{k}") for k in df.columns])


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """``_hash``: the 64-bit hashes of the keys that more than one row of ``df`` holds (and of those
    that share such a hash).  Moves a hash a row, never the row."""
    hashes = df.groupBy(F.xxhash64(key).alias(HASH)).agg(F.count(F.lit(1)).alias("_n"))
    return hashes.where("_n > 1").select(HASH)


def latest_of_repeated(df: DataFrame, key: str, repeated: DataFrame, order: Sequence[str] = (),
                       descending: bool = False) -> DataFrame:
    """The rows of ``latest_by_key`` for a stored table ``df``, given its ``repeated_keys`` (stored, and
    small enough to be broadcast): a row whose key stands alone stays where it is."""
    at, known = F.xxhash64(key), F.broadcast(repeated)
    once = df.join(known, at == F.col(HASH), "left_anti")
    again = df.join(known, at == F.col(HASH), "left_semi")
    return once.unionByName(latest_by_key(again, key, order, descending))
