"""Surrogate and calendar keys as column functions."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F


class KeyScheme(Enum):
    """How a natural key becomes a BIGINT surrogate key.

    ``MURMUR32`` is the absolute 32-bit hash that existing warehouses hold. It collides as
    tables grow, likely from some 50,000 keys on, and a collision multiplies rows in a star join.
    ``XXHASH64`` maps integral keys one to one (every step of the 64-bit hash of one word is
    invertible, and no absolute value folds the range), and leaves string keys with a
    64-bit hash; the collision audit covers those.
    """

    MURMUR32 = "murmur32"
    XXHASH64 = "xxhash64"


def hash_key(natural: Column, scheme: KeyScheme = KeyScheme.XXHASH64) -> Column:
    """Surrogate key. The hash depends on the column's type, so keep it equal on both sides."""
    if scheme is KeyScheme.MURMUR32:
        # Widen before abs(): the smallest 32-bit value has no positive counterpart.
        return F.abs(F.hash(natural).cast("bigint"))
    return F.xxhash64(natural)


def nullable_hash_key(natural: Column, scheme: KeyScheme = KeyScheme.XXHASH64) -> Column:
    """Surrogate key that keeps NULL; the plain hash of NULL is a constant."""
    return F.when(natural.isNotNull(), hash_key(natural, scheme))


def date_key(day: Column) -> Column:
    """Calendar key yyyyMMdd as INT, by arithmetic: no string is built per row."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
