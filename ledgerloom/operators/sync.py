"""Keeping a bronze copy of a source table in step with it.

A bronze table holds the source columns, ``is_deleted`` and ``synced_at``, in buckets of its key. It is never
updated in place: a run writes the next version of those buckets in which something changes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.operators.sizing import broadcast_or_shuffle
from ledgerloom.sinks.warehouse import ALL, BUCKET, Current, Layout, Warehouse, Written

BOOKKEEPING = ("is_deleted", "synced_at")
# Parts of a bronze table unless the caller says otherwise (``session.bucket_count``).
BUCKETS = 16


def _values(df: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """Keys and one struct of everything else, in name order; the struct is never NULL here,
    so after an outer join a NULL struct says that the side had no row."""
    rest = sorted(c for c in df.columns if c not in keys and c not in BOOKKEEPING)
    extra = [F.col("synced_at"), F.col("is_deleted")] if "is_deleted" in df.columns else []
    return df.select(
        *keys,
        F.struct(F.lit(True).alias("present"), *rest).alias(alias),
        *[c.alias(f"{alias}_{n}") for c, n in zip(extra, ("synced_at", "is_deleted"))],
    )


def _once_per_key(snapshot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Observation]:
    """The snapshot by key, and what an action over it sees of repeated and NULL keys.

    A merge shuffles by key anyway, so the check costs no pass of its own.
    """
    rest = [F.col(c) for c in snapshot.columns if c not in keys]
    held = F.max(F.struct(F.lit(True).alias("present"), *rest)).alias("held")
    by_key = snapshot.groupBy(*keys).agg(held, F.count(F.lit(1)).alias("copies"))
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    seen = Observation()
    by_key = by_key.observe(seen, F.count(F.when((F.col("copies") > 1) | no_key, 1)).alias("bad"))
    columns = [F.col(c) if c in keys else F.col(f"held.{c}").alias(c) for c in snapshot.columns]
    return by_key.select(*columns), seen


def _checked(snapshot: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The snapshot by key; raises while it runs if a key is repeated or NULL."""
    rest = [F.col(c) for c in snapshot.columns if c not in keys]
    held = F.max(F.struct(F.lit(True).alias("present"), *rest)).alias("held")
    by_key = snapshot.groupBy(*keys).agg(held, F.count(F.lit(1)).alias("copies"))
    sound = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.col("copies") == 1)
    message = F.lit(f"{what}: a value of {', '.join(keys)} is repeated or NULL")
    by_key = by_key.where(F.when(sound, True).otherwise(F.raise_error(message).cast("boolean")))
    columns = [F.col(c) if c in keys else F.col(f"held.{c}").alias(c) for c in snapshot.columns]
    return by_key.select(*columns)


def initial_load(snapshot: DataFrame, synced_at: Column) -> DataFrame:
    return snapshot.withColumns({"is_deleted": F.lit(False), "synced_at": synced_at})


def live(bronze: DataFrame) -> DataFrame:
    """The source columns of the rows that still exist at the source."""
    return bronze.where(~F.col("is_deleted")).drop(*BOOKKEEPING)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key of either snapshot with what happened to it. NULLs compare as values.

    Both snapshots must have unique keys: repeated ones would pair up. The query raises where it meets a
    repeated or NULL key; that is seen in the shuffle that the comparison needs anyway.
    """
    old, new = _checked(old, keys, "old snapshot"), _checked(new, keys, "new snapshot")
    both = _values(old, keys, "before").join(_values(new, keys, "after"), list(keys), "full")
    before, after = F.col("before"), F.col("after")
    change = (
        F.when(before.isNull(), "insert")
        .when(after.isNull(), "delete")
        .when(before.eqNullSafe(after), "unchanged")
        .otherwise("update")
    )
    return both.select(*keys, change.alias("change_type"))


def merge_snapshot(
    bronze: DataFrame, snapshot: DataFrame, keys: Sequence[str], synced_at: Column
) -> DataFrame:
    """Next bronze version after a full snapshot of the source.

    New and changed rows take the snapshot's values, missing rows stay with ``is_deleted``
    set, and a row that reappears is live again. Untouched rows keep their ``synced_at``.
    The snapshot's keys must be unique (``sync_tables`` checks), those of the bronze table
    then are.
    """
    both = _values(bronze, keys, "before").join(
        _values(snapshot, keys, "after"), list(keys), "full"
    )
    before, after = F.col("before"), F.col("after")
    gone = after.isNull()
    untouched = F.when(gone, F.col("before_is_deleted")).otherwise(
        before.eqNullSafe(after) & ~F.col("before_is_deleted")
    )
    row = F.coalesce(after, before)
    values = [
        F.col(c) if c in keys else row[c].alias(c)
        for c in bronze.columns
        if c not in BOOKKEEPING
    ]
    return both.select(
        *values,
        gone.alias("is_deleted"),
        F.when(F.coalesce(untouched, F.lit(False)), F.col("before_synced_at"))
        .otherwise(synced_at)
        .alias("synced_at"),
    )


def latest_per_key(
    changes: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the last by ``order_by``, then by all other columns in name order.

    A partial maximum runs before the shuffle, so many copies of one key cost one row each
    task, and the same input always gives the same row.
    """
    rest = sorted(c for c in changes.columns if c not in keys and c not in order_by)
    ranked = F.struct(F.lit(True).alias("present"), *order_by, *rest)
    picked = changes.groupBy(*keys).agg(F.max(ranked).alias("last"))
    return picked.select(
        *[F.col(c) if c in keys else F.col(f"last.{c}").alias(c) for c in changes.columns]
    )


def latest_or_tied(
    changes: DataFrame, keys: Sequence[str], rank: Sequence[str], tied: str
) -> DataFrame:
    """One row per key: the last by ``rank``; ``tied`` says that others of that rank differ."""
    rest = sorted(c for c in changes.columns if c not in keys and c not in rank)
    values = F.struct(F.lit(True).alias("present"), *rest)
    by_rank = changes.groupBy(*keys, *rank).agg(
        F.max(values).alias("values"), (F.max(values) != F.min(values)).alias(tied)
    )
    ranked = F.struct(F.lit(True).alias("present"), *rank, "values", tied)
    picked = by_rank.groupBy(*keys).agg(F.max(ranked).alias("last"))
    place = {c: f"last.{c}" for c in rank} | {c: f"last.values.{c}" for c in rest}
    return picked.select(
        *[F.col(place.get(c, c)).alias(c) for c in changes.columns], F.col(f"last.{tied}").alias(tied)
    )


def upsert(
    bronze: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    synced_at: Column,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Next bronze version after a set of changed rows, at most one per key.

    With ``order_by``, a change older than the row it would replace is left out. Where the
    changes measure small, their keys are broadcast and the bronze table is not shuffled.
    The changes are read several times, so they should be a stored table.
    """
    if order_by:
        held = bronze.join(broadcast_or_shuffle(changes.select(*keys)), list(keys), "left_semi")
        newer = held.select(*keys, F.struct(*order_by).alias("held_order"))
        change_order = F.struct(*[changes[c] for c in order_by])
        same_key = reduce(lambda a, b: a & b, [changes[k] == newer[k] for k in keys])
        changes = changes.join(newer, same_key & (newer["held_order"] > change_order), "left_anti")
    changed_keys = broadcast_or_shuffle(changes.select(*keys))
    kept = bronze.join(changed_keys, list(keys), "left_anti")
    return kept.unionByName(initial_load(changes, synced_at).select(*bronze.columns))


def changed_rows(bronze: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that a full snapshot changes in a bronze table, as they are to be held from now on.

    Source columns, ``is_deleted`` and ``change_type``: ``insert`` (also of a deleted row that is back),
    ``update`` or ``delete``. Both sides must have unique keys.
    """
    both = _values(bronze, keys, "before").join(
        _values(snapshot, keys, "after"), list(keys), "full"
    )
    before, after = F.col("before"), F.col("after")
    was_deleted = F.col("before_is_deleted")
    change = (
        F.when(before.isNull(), "insert")
        .when(after.isNull() & ~was_deleted, "delete")
        .when(after.isNull(), None)
        .when(was_deleted, "insert")
        .when(~before.eqNullSafe(after), "update")
    )
    row = F.coalesce(after, before)
    values = [
        F.col(c) if c in keys else row[c].alias(c)
        for c in bronze.columns
        if c not in BOOKKEEPING
    ]
    changed = both.select(*values, after.isNull().alias("is_deleted"), change.alias("change_type"))
    return changed.where(F.col("change_type").isNotNull())


def merge_changes(
    bronze: DataFrame, changes: DataFrame, keys: Sequence[str], synced_at: Column
) -> DataFrame:
    """Next version of some bronze rows after the changes to them, at most one per key."""
    kept = bronze.join(broadcast_or_shuffle(changes.select(*keys)), list(keys), "left_anti")
    rows = changes.withColumn("synced_at", synced_at)
    return kept.unionByName(rows.select(*bronze.columns))


def sync_tables(
    warehouse: Warehouse,
    snapshots: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    synced_at: Column,
    run_id: str,
    buckets: int = BUCKETS,
) -> dict[str, int]:
    """Bring bronze tables in step with full snapshots and publish them together.

    A table that is not there yet is loaded into ``buckets`` of its keys (``Layout.by_bucket``). Any
    other is compared with its snapshot; what changed is written down, and only the buckets with a change are read
    again and written anew. Gives the rows written.

    Running the same ``run_id`` again starts from the versions before it. Repeated or NULL keys in a snapshot raise, and so
    does another run that published one of the tables meanwhile; nothing is published then.
    """
    held = warehouse.current(list(snapshots), other_than_run=run_id)
    first, compared, checks, layouts = {}, {}, {}, {}
    for name, snapshot in snapshots.items():
        rows, checks[name] = _once_per_key(snapshot, keys[name])
        if name not in held:
            layouts[name] = Layout.by_bucket(keys[name], buckets)
            first[name] = initial_load(rows, synced_at)
        else:
            layouts[name] = Layout.by_bucket(keys[name], held[name].buckets or buckets)
            bronze = warehouse.open(name, held[name]).drop(BUCKET)
            compared[name] = changed_rows(bronze, rows, keys[name])
    loaded = warehouse.stage(run_id, first, layouts)
    changes = warehouse.stage(f"{run_id}-changes", compared)
    for name, seen in checks.items():
        bad = seen.get.get("bad", 0)
        if bad:
            what = f"{bad} values of {', '.join(keys[name])} are repeated or NULL"
            raise ValueError(f"snapshot of {name}: {what}")

    def merge(written: Written) -> Written:
        name, layout = written.name, layouts[written.name]
        rows = warehouse.read_written(written).drop("change_type")
        touched = touched_parts(held[name], rows, layout)
        bronze = warehouse.open(name, held[name], touched).drop(BUCKET)
        merged = merge_changes(bronze, rows, keys[name], synced_at)
        return warehouse.stage_parts(run_id, name, merged, layout, touched)

    with ThreadPoolExecutor(max_workers=max(1, len(changes))) as pool:
        merged = list(pool.map(merge, changes))
    versions = {name: held[name].path if name in held else None for name in snapshots}
    return warehouse.publish(run_id, [*loaded, *merged], versions)


def touched_parts(table: Current, rows: DataFrame, layout: Layout) -> list[str]:
    """The partitions of a table that the rows fall into; all of a table that isn't cut that way yet."""
    if table.buckets != layout.buckets:
        return [ALL]
    return sorted(str(r[0]) for r in rows.select(layout.value).distinct().collect())
