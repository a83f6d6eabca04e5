"""Bronze tables kept fresh from a stream of changed rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.sync import BUCKETS, latest_per_key, touched_parts, upsert
from ledgerloom.sinks.warehouse import BUCKET, Layout, Warehouse
from ledgerloom.streaming.files import DELIVERY
from ledgerloom.streaming.landing import Landing

TIED = "changes_tied"


def run_upserts(
    changes: DataFrame,
    store: Warehouse,
    table: str,
    keys: Sequence[str],
    folder: str,
    order_by: Sequence[str] = (),
) -> None:
    """Upsert all changes that are there now into a loaded bronze table.

    Of several changes to a key the last by ``order_by`` counts, then the last delivered: by the
    time and path of its file where the stream has these columns, else by its micro-batch. So
    the result does not depend on how files fall into micro-batches. Rows of one file that tie
    with different values raise, and nothing is published. A change older than what the table
    holds does not count at all. Only the buckets that changes fall into are read and written anew, once per run, not once
    per micro-batch.
    """
    landing = Landing(store, table, folder, keys)
    delivery = [c for c in DELIVERY if c in changes.columns]
    rank = (*order_by, *delivery)
    landing.land(changes, rank, TIED if delivery else None)
    landed, last = landing.new_rows()
    if last is None:
        return
    latest = latest_per_key(landed, keys, rank if delivery else (*rank, "batch_id"))
    latest = landing.settle(latest.drop("batch_id"), last)
    if delivery:
        tied = latest.where(TIED).select(*keys).head(5)
        if tied:
            found = ", ".join(str(tuple(row)) for row in tied)
            raise ValueError(f"changes of {table} with one key and order differ, such as {found}")
        latest = latest.drop(TIED, *delivery)
    now = F.lit(datetime.now(timezone.utc)).cast("timestamp")
    held = store.current([table])[table]
    layout = Layout.by_bucket(keys, held.buckets or BUCKETS)
    touched = touched_parts(held, latest, layout)
    bronze = store.open(table, held, touched).drop(BUCKET)
    rows = upsert(bronze, latest, keys, now, order_by)
    written = store.stage_parts(landing.run_id(last), table, rows, layout, touched)
    landing.publish(last, [written], {table: held.path})
