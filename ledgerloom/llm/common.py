"""Helpers that the operators share: written intermediate tables and array hashing of words."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import new_folder

# A word is a run of other characters than these.
WORD_SPACE = r"[\x20\x09-\x0D]+"
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"

# Texts are worked on in blocks of about this size, so that arrays stay small.
BLOCK_BYTES = 1024 * 1024

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# --- written tables ------------------------------------------------------------------------


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within this, the shuffle files of a query go when the query ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it: lineage ends here, and what is lost
    with an executor afterwards is read again rather than computed again."""
    spark = df.sparkSession
    path = new_folder(spark, f"llm-{name}")
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


# --- word arrays ---------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_LONG_WORD = 256


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int) -> None:
        self._bases = (base & _MASK, pow(base, -1, 1 << 64))
        self._tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def up_to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._tables[0]) < n:
            size = -(-n >> 16) << 16
            for k, base in enumerate(self._bases):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                self._tables[k] = np.cumprod(table, dtype=np.uint64)
        return self._tables[0][:n], self._tables[1][:n]


@lru_cache(maxsize=16)
def _powers(base: int) -> _Powers:
    return _Powers(base)


def space_table(spaces: bytes = SPACE_BYTES) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(spaces, np.uint8)] = True
    return table


_SPACES = space_table()


@dataclass
class Words:
    """Words of some texts: a 64-bit hash for each; text ``i`` has ``first[i]:first[i + 1]``.

    ``starts`` and ``ends`` are byte positions in ``data``.
    """

    hashes: np.ndarray
    first: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_ends(self) -> np.ndarray:
        """For each word, the index after the last word of its text."""
        return np.repeat(self.first[1:], self.counts)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def hash_words(data: np.ndarray, bounds: np.ndarray, spaces: np.ndarray = _SPACES) -> Words:
    """Hash all words of the texts ``data[bounds[i]:bounds[i + 1]]`` (UTF-8 bytes).

    Long texts are worked on in pieces that end between words.
    """
    hashes, starts, ends = [], [], []
    at, stop = int(bounds[0]), int(bounds[-1])
    cuts = bounds[1:-1]
    while at < stop:
        to = min(stop, at + BLOCK_BYTES)
        if to < stop:
            gaps = np.flatnonzero(spaces[data[at:to]])
            # a piece without any gap is one word so far: go on to its end
            while not len(gaps) and to < stop:
                to = min(stop, to + BLOCK_BYTES)
                gaps = np.flatnonzero(spaces[data[at:to]])
            if to < stop:
                to = at + int(gaps[-1]) + 1
        own = cuts[np.searchsorted(cuts, at, "right") : np.searchsorted(cuts, to)] - at
        h, s, e = _hash_piece(data[at:to], own, spaces)
        hashes.append(h)
        starts.append(s + at)
        ends.append(e + at)
        at = to
    empty = np.zeros(0, np.int64)
    all_starts = np.concatenate([empty, *starts])
    return Words(
        np.concatenate([np.zeros(0, np.uint64), *hashes]),
        np.searchsorted(all_starts, bounds).astype(np.int64),
        data,
        all_starts,
        np.concatenate([empty, *ends]),
    )


def _hash_piece(data, cuts, spaces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data)
    inside = ~spaces[data]
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    if len(cuts):
        begins[cuts] = inside[cuts]
        before = cuts[cuts > 0] - 1
        finishes[before] = inside[before]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes) + 1
    power, inverse = _powers(_BASE).up_to(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    lengths = ends - starts
    hashes = mixed((sums[ends] - sums[starts]) * inverse[starts] + lengths.astype(np.uint64))
    for i in np.flatnonzero(lengths > _LONG_WORD):  # sums are weak for very long words
        hashes[i] = _digest(data[starts[i] : ends[i]].tobytes())
    return hashes, starts, ends


def _digest(word: bytes) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def span_hashes(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray, base: int) -> np.ndarray:
    """Hash of the words ``starts[i]:stops[i]`` for every ``i``, each in constant time."""
    power, inverse = _powers(base).up_to(len(hashes) + 1)
    sums = np.empty(len(hashes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(hashes * power[: len(hashes)], out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * inverse[starts])


def gram_hashes(words: Words, k: int, base: int = 0xD6E8FEB86659FD93) -> tuple[np.ndarray, np.ndarray]:
    """Start index and hash of every run of ``k`` words that lies in one text."""
    starts = np.flatnonzero(np.arange(k, len(words.hashes) + k) <= words.row_ends())
    return starts, span_hashes(words.hashes, starts, starts + k, base)


# --- Python code on the executors ------------------------------------------------------------

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    The archive is made beside the files of the driver; Spark's own file server hands it out.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="ledgerloom-code-")) / "ledgerloom-code.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for module in sorted(package.rglob("*.py")):
            target.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


# --- Arrow batches -------------------------------------------------------------------------


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the bounds of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return whole, bounds.astype(np.int64)


def text_blocks(column: pa.Array, block: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a string column with their bytes and bounds, about ``block`` bytes each."""
    data, bounds = text_bytes(column)
    at, n = 0, len(bounds) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + block, "right")) - 1)
        to = min(to, n)
        yield at, to, data, bounds[at : to + 1]
        at = to


def word_blocks(
    column: pa.Array, spaces: np.ndarray = _SPACES, block: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, Words]]:
    for at, to, data, bounds in text_blocks(column, block):
        yield at, to, hash_words(data, bounds, spaces)


def longs(values: np.ndarray) -> pa.Array:
    """Unsigned hashes as Spark's signed longs."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def map_arrow(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""

    ship(df.sparkSession)

    def run(batches):
        for batch in batches:
            yield from function(batch)
        # workers are used again, and what they hold counts as the executor's memory
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


# --- fixed-size counts ---------------------------------------------------------------------

COUNT_BLOCKS = 1024
# Slots of which a task holds a range at once.
HELD_SLOTS = 1 << 17


def hashed_counts(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> np.ndarray:
    """Counts of 64-bit hashes over all rows, by their upper ``bits`` bits.

    Tasks count into arrays of ``2**bits`` counters; the arrays are cut into blocks and summed
    block by block in Spark, one row at a time. What reaches the driver is one array of that
    size, whatever the input.
    """
    size, blocks = 1 << bits, min(COUNT_BLOCKS, 1 << bits)
    shift = np.uint64(64 - bits)

    def count(batches):
        total = np.zeros(size, np.int64)
        seen = False
        for batch in batches:
            for found in hashes(batch):
                seen = True
                np.add.at(total, (found >> shift).astype(np.int64), 1)
        if seen:
            cut = total.reshape(blocks, -1)
            own = np.flatnonzero(cut.any(axis=1))
            rows = [cut[i].tobytes() for i in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int32()), pa.array(rows, pa.binary())], ["block", "counts"]
            )

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(counts.as_buffer(), np.int64)
                if block in sums:
                    sums[block] += own
                else:
                    sums[block] = own.copy()
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                ["block", "counts"],
            )

    schema = "block int, counts binary"
    spark = df.sparkSession
    ship(spark)
    parts = min(64, blocks)
    with shuffles_removed(spark):
        rows = df.mapInArrow(count, schema).repartition(parts, "block").mapInArrow(add, schema).collect()
    counts = np.zeros((blocks, size // blocks), np.int64)
    for block, own in rows:
        counts[block] = np.frombuffer(own, np.int64)
    return counts.reshape(-1)


class SlotRanges:
    """Least and greatest mark of each slot seen, held until there are ``HELD_SLOTS`` of them."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, slots: np.ndarray, marks: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(slots), HELD_SLOTS):
            own = marks[at : at + HELD_SLOTS]
            self._merge([(slots[at : at + HELD_SLOTS], own, own)])
            if self.held > HELD_SLOTS:
                parts, self.parts = self.parts, []
                self._merge(parts)
                if self.held > HELD_SLOTS // 2:
                    yield from self.rest()

    def _merge(self, parts: list) -> None:
        slots, low, high = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(slots, kind="stable")
        slots = slots[order]
        first = np.flatnonzero(np.diff(slots, prepend=-1))
        self.parts.append(
            (slots[first], np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first))
        )
        self.held = sum(len(p[0]) for p in self.parts)

    def rest(self) -> Iterator[pa.RecordBatch]:
        for slots, low, high in self.parts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots.astype(np.int32)), pa.array(low), pa.array(high)], ["slot", "low", "high"]
            )
        self.parts, self.held = [], 0


def single_marks(
    df: DataFrame, marked: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]], bits: int
) -> np.ndarray:
    """Whether the hashes of a slot, by their upper ``bits`` bits, have one mark over all rows.

    ``marked`` gives hashes and a mark (a signed long) for each; a slot without hashes has none. Tasks
    hand on the ranges of the slots they see, a few MB at a time, Spark joins them by slot, and
    ``2**bits`` bits reach the driver, whatever the input.
    """
    size, shift = 1 << bits, np.uint64(64 - bits)

    def span(batches):
        ranges = SlotRanges()
        for batch in batches:
            for found, marks in marked(batch):
                yield from ranges.add((found >> shift).astype(np.int64), marks)
        yield from ranges.rest()

    spark = df.sparkSession
    ship(spark)
    one = (
        df.mapInArrow(span, "slot int, low long, high long")
        .groupBy("slot")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low = high")
    )
    # Spark counts places from 1
    place = F.col("slot").cast("long") + 1
    maps = one.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    with shuffles_removed(spark):
        rows = maps.collect()
    single = np.zeros(size, bool)
    for bucket, own in rows:
        found = np.unpackbits(np.frombuffer(own, np.uint8), bitorder="little").view(bool)
        at = (bucket - 1) * len(found)
        single[at : at + len(found)] = found[: size - at]
    return single


def empty_as_null(column: str) -> Column:
    return F.when(F.length(column) > 0, F.col(column))
