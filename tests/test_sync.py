from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import sync
from ledgerloom.plans.warehouse import load_time
from ledgerloom.session import new_folder
from ledgerloom.sinks.warehouse import Warehouse

KEYS = ("id", "part")

OLD = [(1, "a", "x", 1), (2, "a", "x", 2), (2, "b", None, 3), (3, "a", "y", None), (4, "a", "z", 4)]
NEW = [(1, "a", "x", 1), (2, "a", None, 2), (2, "b", "v", 3), (4, "a", "z", 5), (5, "a", "n", 0)]


def day(number):
    return load_time(datetime(2024, 1, number, tzinfo=timezone.utc))


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, part string, name string, amount int").select(
        "id", "part", "name", F.col("amount").cast("decimal(10,2)")
    )


def values(df):
    return {
        (r.id, r.part): (r.name, None if r.amount is None else int(r.amount))
        for r in df.collect()
    }


def bookkeeping(df):
    rows = df.select(*KEYS, "is_deleted", F.dayofmonth("synced_at").alias("day")).collect()
    return {(r.id, r.part): (r.is_deleted, r.day) for r in rows}


def plain(rows):
    return {(i, p): (n, a) for i, p, n, a in rows}


def test_diff_is_null_safe(spark):
    diff = sync.snapshot_diff(frame(spark, OLD), frame(spark, NEW), KEYS)
    assert {(r.id, r.part): r.change_type for r in diff.collect()} == {
        (1, "a"): "unchanged",
        (2, "a"): "update",
        (2, "b"): "update",
        (3, "a"): "delete",
        (4, "a"): "update",
        (5, "a"): "insert",
    }


def test_diff_of_a_table_with_keys_only(spark):
    old, new = (spark.createDataFrame(r, "id int") for r in ([(1,), (2,)], [(2,), (3,)]))
    diff = sync.snapshot_diff(old, new, ["id"])
    assert {r.id: r.change_type for r in diff.collect()} == {
        1: "delete",
        2: "unchanged",
        3: "insert",
    }


def test_merge_gives_the_new_snapshot_and_keeps_the_deleted(spark):
    bronze = sync.initial_load(frame(spark, OLD), day(1))
    merged = sync.merge_snapshot(bronze, frame(spark, NEW), KEYS, day(2))
    assert merged.schema.names == bronze.schema.names
    assert values(sync.live(merged)) == plain(NEW)
    assert values(merged)[(3, "a")] == ("y", None)
    assert bookkeeping(merged) == {
        (1, "a"): (False, 1),
        (2, "a"): (False, 2),
        (2, "b"): (False, 2),
        (3, "a"): (True, 2),
        (4, "a"): (False, 2),
        (5, "a"): (False, 2),
    }


def test_merge_without_change_touches_nothing(spark):
    bronze = sync.initial_load(frame(spark, OLD), day(1))
    once = sync.merge_snapshot(bronze, frame(spark, NEW), KEYS, day(2))
    twice = sync.merge_snapshot(once, frame(spark, NEW), KEYS, day(3))
    assert bookkeeping(once) == bookkeeping(twice)
    assert values(once) == values(twice)


def test_deleted_row_that_reappears_is_live_again(spark):
    bronze = sync.initial_load(frame(spark, OLD), day(1))
    gone = sync.merge_snapshot(bronze, frame(spark, NEW), KEYS, day(2))
    back = sync.merge_snapshot(gone, frame(spark, OLD), KEYS, day(3))
    assert values(sync.live(back)) == plain(OLD)
    assert bookkeeping(back)[(3, "a")] == (False, 3)
    assert bookkeeping(back)[(5, "a")] == (True, 3)


def test_empty_snapshot_deletes_everything(spark):
    bronze = sync.initial_load(frame(spark, OLD), day(1))
    merged = sync.merge_snapshot(bronze, frame(spark, []), KEYS, day(2))
    assert {v for v in bookkeeping(merged).values()} == {(True, 2)}
    assert sync.live(merged).count() == 0
    refilled = sync.merge_snapshot(merged, frame(spark, NEW), KEYS, day(3))
    assert values(sync.live(refilled)) == plain(NEW)


@pytest.mark.parametrize("seed", range(4))
def test_merge_equals_the_snapshot_for_random_changes(spark, seed):
    import random

    rng = random.Random(seed)

    def snapshot():
        keys = {(rng.randrange(30), rng.choice("ab")) for _ in range(40)}
        return [
            (i, p, rng.choice([None, "x", "y"]), rng.choice([None, 1, 2]))
            for i, p in sorted(keys)
        ]

    states = [snapshot() for _ in range(3)]
    bronze = sync.initial_load(frame(spark, states[0]), day(1))
    for number, state in enumerate(states[1:], 2):
        bronze = sync.merge_snapshot(bronze, frame(spark, state), KEYS, day(number))
    assert values(sync.live(bronze)) == plain(states[-1])
    assert set(values(bronze)) == {k for s in states for k in plain(s)}


def test_latest_per_key_takes_the_last_whole_row(spark):
    changes = spark.createDataFrame(
        [(1, 5, "old"), (1, 9, None), (1, 7, "z"), (2, 1, "a"), (2, 1, "b"), (2, 1, "a")],
        "id int, seq int, name string",
    )
    latest = sync.latest_per_key(changes, ["id"], ["seq"])
    assert latest.columns == changes.columns
    assert sorted(tuple(r) for r in latest.collect()) == [(1, 9, None), (2, 1, "b")]


def test_upsert_keeps_other_rows(spark):
    bronze = sync.initial_load(frame(spark, OLD), day(1))
    deleted = sync.merge_snapshot(bronze, frame(spark, OLD[1:]), KEYS, day(2))
    changed = sync.upsert(
        deleted, frame(spark, [(1, "a", "back", 1), (9, "z", "new", 9)]), KEYS, day(3)
    )
    assert values(sync.live(changed)) == plain(
        [*OLD[1:], (1, "a", "back", 1), (9, "z", "new", 9)]
    )
    assert bookkeeping(changed)[(2, "a")] == (False, 1)


@pytest.mark.parametrize("bad", [[OLD[0], OLD[0]], [(None, "a", "x", 1)]])
def test_repeated_or_missing_keys_are_refused(spark, bad):
    store = Warehouse(spark, new_folder(spark, "test"))
    with pytest.raises(ValueError, match="repeated or NULL"):
        sync.sync_tables(store, {"t": frame(spark, bad)}, {"t": KEYS}, day(1), "r")
    assert not store.exists("t")


def test_diff_refuses_repeated_keys(spark):
    twice = frame(spark, [OLD[0], OLD[0]])
    nameless = frame(spark, [(None, "a", "x", 1)])
    for old, new in ((twice, frame(spark, NEW)), (frame(spark, OLD), twice), (nameless, twice)):
        with pytest.raises(Exception, match="repeated or NULL"):
            sync.snapshot_diff(old, new, KEYS).collect()


def test_diff_is_one_job(spark):
    """Keys are checked in the comparison's own shuffles; nothing runs before it."""
    tracker = spark.sparkContext.statusTracker()
    group = "diff-of-snapshots"
    spark.sparkContext.setJobGroup(group, "")
    diff = sync.snapshot_diff(frame(spark, OLD), frame(spark, NEW), KEYS)
    assert list(tracker.getJobIdsForGroup(group)) == []
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_sync_tables_loads_then_merges_and_can_be_run_again(spark):
    store = Warehouse(spark, new_folder(spark, "test"))

    def run(rows, moment, run_id):
        sync.sync_tables(store, {"t": frame(spark, rows)}, {"t": KEYS}, moment, run_id)
        return store.read("t")

    assert bookkeeping(run(OLD, day(1), "first")) == dict.fromkeys(plain(OLD), (False, 1))
    second = bookkeeping(run(NEW, day(2), "second"))
    assert bookkeeping(run(NEW, day(2), "second")) == second
    assert second[(1, "a")] == (False, 1) and second[(3, "a")] == (True, 2)


def test_sync_refuses_repeated_and_missing_keys(spark):
    store = Warehouse(spark, new_folder(spark, "refused"))
    sync.sync_tables(store, {"t": frame(spark, OLD)}, {"t": KEYS}, day(1), "one")
    before = store.paths(["t"])
    for bad in ([*NEW, NEW[0]], [*NEW, (None, "a", "x", 1)]):
        with pytest.raises(ValueError, match="snapshot of t: 1 values"):
            sync.sync_tables(store, {"t": frame(spark, bad)}, {"t": KEYS}, day(2), "two")
        with pytest.raises(ValueError, match="snapshot of new: 1 values"):
            sync.sync_tables(store, {"new": frame(spark, bad)}, {"new": KEYS}, day(2), "two")
    assert store.paths(["t", "new"]) == {**before, "new": None}


def test_sync_notices_an_overlapping_run(spark, monkeypatch):
    store = Warehouse(spark, new_folder(spark, "overlap"))
    sync.sync_tables(store, {"t": frame(spark, OLD)}, {"t": KEYS}, day(1), "one")
    stage = store.stage

    def stage_slowly(run_id, tables, layouts=None):
        written = stage(run_id, tables, layouts)
        other = Warehouse(spark, store.root)
        sync.sync_tables(other, {"t": frame(spark, NEW)}, {"t": KEYS}, day(2), "other")
        return written

    monkeypatch.setattr(store, "stage", stage_slowly)
    with pytest.raises(RuntimeError, match="another run published t during two"):
        sync.sync_tables(store, {"t": frame(spark, OLD)}, {"t": KEYS}, day(2), "two")
    assert values(sync.live(store.read("t"))) == plain(NEW)


def test_a_merge_shuffles_its_snapshot_once(spark):
    bronze = sync.initial_load(frame(spark, OLD), day(1))
    rows, _ = sync._once_per_key(frame(spark, NEW), KEYS)
    merged = sync.merge_snapshot(bronze, rows, KEYS, day(2))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2
