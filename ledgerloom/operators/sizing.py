"""Broadcast behind a measured size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 8 * 1024 * 1024
ROW_OVERHEAD_BYTES = 16


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows, summed by the executors; one number reaches the driver."""
    row = F.lit(ROW_OVERHEAD_BYTES + 8 * len(df.columns)).cast("bigint")
    texts = [
        F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        for f in df.schema
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    return df.agg(F.sum(reduce(lambda a, b: a + b, texts, row))).first()[0] or 0


def is_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint if the frame measures at most ``max_bytes``, else the frame unhinted.

    For derived tables, whose size Spark's planner can only overestimate. Unhinted, the join
    is a shuffle join with runtime skew splitting, unless the planner takes the frame for small:
    of stored tables use ``broadcast_or_shuffle``.
    """
    return F.broadcast(df) if is_small(df, max_bytes) else df


def shuffle_if_large(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The frame, never to be broadcast if it measures more than ``max_bytes``.

    The planner goes by the size of compressed files and by the declared width of their columns. A few narrow columns
    of a stored table may be a hundred times as large as that in memory, and a broadcast is held by the driver whole.
    """
    return df if is_small(df, max_bytes) else df.hint("merge")


def broadcast_or_shuffle(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint if the frame measures at most ``max_bytes``, else a hint for a shuffle join."""
    return F.broadcast(df) if is_small(df, max_bytes) else df.hint("merge")
