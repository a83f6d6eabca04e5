"""What a Python worker takes beside the JVM while near duplicates are found."""

import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import common, near_duplicates


def test_slots_with_one_mark(spark):
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 1 << 63, 60_000, dtype=np.uint64) << np.uint64(1)
    hashes[::7] = hashes[0]
    hashes[1], hashes[2] = 0, (1 << 64) - 1  # the first and the last slot
    marks = rng.integers(-3, 3, len(hashes))
    rows = list(zip(hashes.view(np.int64).tolist(), marks.tolist()))
    df = spark.createDataFrame(rows, "hash long, mark long").repartition(3)

    def marked(batch):
        yield tuple(np.asarray(batch.column(k)).view(t) for k, t in ((0, np.uint64), (1, np.int64)))

    for bits in (10, 17):
        seen = defaultdict(set)
        for h, m in zip(hashes.tolist(), marks.tolist()):
            seen[h >> (64 - bits)].add(m)
        single = common.single_marks(df, marked, bits)
        assert len(single) == 1 << bits
        assert set(np.flatnonzero(single).tolist()) == {s for s, m in seen.items() if len(m) == 1}
    assert not common.single_marks(df.where(F.lit(False)), marked, 10).any()


@pytest.mark.parametrize("different", [1000, 1 << 22])
def test_ranges_of_all_slots_are_held_in_a_few_mb(different):
    rng = np.random.default_rng(6)
    low, high = np.full(1 << 22, 1 << 62), np.full(1 << 22, -(1 << 62))
    got = low.copy(), high.copy()
    ranges, sent = common.SlotRanges(), 0

    def take(batches):
        n = 0
        for batch in batches:
            slots, *sides = (np.asarray(c) for c in batch.columns)
            np.minimum.at(got[0], slots, sides[0])
            np.maximum.at(got[1], slots, sides[1])
            n += len(slots)
        return n

    tracemalloc.start()
    for _ in range(40):
        slots, marks = rng.integers(0, different, 50_000), rng.integers(-9, 9, 50_000)
        np.minimum.at(low, slots, marks)
        np.maximum.at(high, slots, marks)
        sent += take(ranges.add(slots, marks))
    sent += take(ranges.rest())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32e6  # two arrays of all slots take 67 MB
    assert sent <= 40 * 50_000 if different > 1000 else sent <= 100 * different
    assert np.array_equal(got[0], low) and np.array_equal(got[1], high)


def test_workers_that_compare_hold_no_variates(spark):
    settings = near_duplicates.Settings()
    levels = spark.sparkContext.broadcast(np.zeros(1 << settings.df_bits, np.uint8))
    text = " ".join(f"w{i}" for i in range(40))
    table = pa.RecordBatch.from_pydict({"doc_id": [1], "text_id": [b"a"], "text": [text]})
    pairs = pa.RecordBatch.from_pydict({"u": [b"a"], "v": [b"b"], "u_text": [text], "v_text": [text]})
    rooted = pa.RecordBatch.from_pydict({"root_hash": [1], "text": [text]})
    for later, batch in ((near_duplicates._verify(levels, settings), pairs), (near_duplicates._rooted_hashes(settings), rooted)):
        assert len(list(near_duplicates._sign(levels, settings)(table))) == 1
        assert near_duplicates._variates.cache_info().currsize == 1
        assert len(list(later(batch))) == 1
        assert near_duplicates._variates.cache_info().currsize == 0


def test_variates_are_drawn_in_little_more_than_they_take():
    near_duplicates._variates.cache_clear()
    tracemalloc.start()
    kept = near_duplicates._variates(80, 7)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    near_duplicates._variates.cache_clear()
    assert sum(a.nbytes for a in kept) <= held
    assert peak < held + 4e6
    random = np.random.default_rng(7)  # the same numbers as drawn at once
    assert np.array_equal(kept[0], random.gamma(2.0, size=kept[0].shape).astype(np.float32))
