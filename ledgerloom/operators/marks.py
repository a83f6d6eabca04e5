"""Rows with or without one of many keys, where the keys are too many to be broadcast.

The marks of a set of keys are bits, one for every slot that a key hashes to. They have the same size whatever the
number of keys, so they can be broadcast. A row whose bit is not set has none of the keys, for sure, and is not shuffled;
only the others meet the keys themselves. Where keys crowd the slots, more rows are shuffled; no result changes.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 8 MB of bits; a multiple of the bits of a block.
SLOTS = 1 << 26
_WORD_BITS, _BLOCK_WORDS = 64, 512


class Keys(NamedTuple):
    """Distinct keys, the only column of a frame; with the marks of so many slots where the frame is large."""

    rows: DataFrame
    marks: DataFrame | None = None
    slots: int = SLOTS


def marks_of(keys: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The marks of a column of keys: numbered blocks of bits, all of them, also those without any key."""
    placed = keys.select(F.pmod(F.xxhash64(keys.columns[0]), F.lit(slots)).alias("slot"))
    held = placed.selectExpr(
        f"slot div {_WORD_BITS} AS word", f"shiftleft(1L, cast(slot % {_WORD_BITS} AS int)) AS bits"
    )
    unset = keys.sparkSession.range(slots // _WORD_BITS).selectExpr("id AS word", "0L AS bits")
    words = held.unionByName(unset).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.array_sort(F.collect_list(F.struct("word", "bits")))
    blocks = words.groupBy(F.expr(f"word div {_BLOCK_WORDS}").alias("mark_block"))
    return blocks.agg(F.transform(in_order, lambda word: word["bits"]).alias("mark_words"))


def _split(rows: DataFrame, keys: Keys) -> tuple[DataFrame, DataFrame]:
    """Rows that may have one of the keys and rows that have none."""
    slot = F.pmod(F.xxhash64(keys.rows.columns[0]), F.lit(keys.slots))
    placed = rows.withColumn("mark_slot", slot).withColumn(
        "mark_block", F.expr(f"mark_slot div {_WORD_BITS * _BLOCK_WORDS}")
    )
    bit = F.expr(
        f"shiftright(mark_words[cast(mark_slot div {_WORD_BITS} % {_BLOCK_WORDS} AS int)],"
        f" cast(mark_slot % {_WORD_BITS} AS int)) & 1L"
    )
    # the second condition is true of every row, but not deterministic: Spark would else move a later semi or anti join
    # below this one, and have all rows shuffled before their bits are looked at
    found = placed.join(F.broadcast(keys.marks), "mark_block").where(F.spark_partition_id() >= 0)
    return found.where(bit == 1).select(*rows.columns), found.where(bit == 0).select(*rows.columns)


def _marked(rows: DataFrame, keys: Keys) -> bool:
    """Whether there are marks that hold for the rows: the hash depends on the column's type."""
    column = keys.rows.columns[0]
    return keys.marks is not None and rows.schema[column].dataType == keys.rows.schema[column].dataType


def having(rows: DataFrame, keys: Keys) -> DataFrame:
    """Rows with one of the keys."""
    possible = _split(rows, keys)[0] if _marked(rows, keys) else rows
    return possible.join(keys.rows, keys.rows.columns[0], "left_semi").select(*rows.columns)


def lacking(rows: DataFrame, keys: Keys) -> DataFrame:
    """Rows with none of the keys; those that the marks rule out are passed on as they are read."""
    possible, others = _split(rows, keys) if _marked(rows, keys) else (rows, None)
    left = possible.join(keys.rows, keys.rows.columns[0], "left_anti").select(*rows.columns)
    return left if others is None else others.unionByName(left)


def having_any(rows: DataFrame, *sets: Keys) -> DataFrame:
    """Rows with a key of any of the sets, each once."""
    found, others = [], rows
    for keys in sets:
        found.append(having(others, keys))
        others = lacking(others, keys)
    return reduce(DataFrame.unionByName, found)


def lacking_all(rows: DataFrame, *sets: Keys) -> DataFrame:
    """Rows without a key of any of the sets."""
    return reduce(lacking, sets, rows)
