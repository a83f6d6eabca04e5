"""Payments fact kept fresh from a stream of payment rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import KeyScheme
from ledgerloom.operators.facts import PAYMENT_YEAR, payers, payment_columns
from ledgerloom.operators.sizing import broadcast_if_small
from ledgerloom.operators.sync import BUCKETS, latest_per_key, touched_parts
from ledgerloom.sinks.warehouse import BUCKET, MOST_PARTS, Current, Layout, Warehouse
from ledgerloom.streaming.landing import Landing

PAYMENT_KEY = ("customer_number", "check_number")
# Grows with the deliveries, so it is kept apart from the table a full build replaces.
TABLE = "fact_payments_feed"
WAITING = "payments_waiting"
BUILT = "fact_payments"


def current_payments(store: Warehouse) -> DataFrame:
    """Each payment once: those of the last full build, and those that only the feed has yet.

    Both must have been made with the same key scheme.
    """
    stored = [name for name, path in store.paths([BUILT, TABLE]).items() if path]
    if TABLE not in stored:
        return without_layout(store.read(BUILT))
    fed = without_layout(store.read(TABLE))
    if BUILT not in stored:
        return fed
    built = without_layout(store.read(BUILT))
    late = fed.join(built.select(*PAYMENT_KEY), list(PAYMENT_KEY), "left_anti")
    return built.unionByName(late)


def without_layout(payments: DataFrame) -> DataFrame:
    """Payments without the columns by which they are cut into partitions."""
    return payments.drop(BUCKET, PAYMENT_YEAR)


class PaymentsFeed:
    """Appends each payment once, however often and however late its row is delivered.

    New payments are matched by key against those the table holds, so there is no lateness
    bound that could lose one and no state held in memory. The table lies in buckets of the payment key and so is its
    own index: a delivery reads the keys of the buckets that it falls into and adds a part to each of them. Buckets
    are put together again as they gather parts, so neither the files of a bucket nor what the driver looks up grow
    with the number of runs. A payment of a customer not known yet waits, in a table of its own, and is tried again by
    the next run that brings payments.
    """

    def __init__(
        self,
        store: Warehouse,
        folder: str,
        customers: Callable[[], DataFrame],
        loaded_at: Column,
        keys: KeyScheme = KeyScheme.XXHASH64,
        buckets: int = BUCKETS,
        most_parts: int = MOST_PARTS,
    ) -> None:
        self.store = store
        self.landing = Landing(store, TABLE, folder, PAYMENT_KEY)
        self.customers = customers
        self.loaded_at = loaded_at
        self.keys = keys
        self.buckets = buckets
        self.most_parts = most_parts

    def run(self, payments: DataFrame) -> None:
        """Append all payments that are there now."""
        self.landing.land(payments.select(*PAYMENT_KEY, "payment_date", "amount"))
        landed, last = self.landing.new_rows()
        landed = landed.drop("batch_id")
        held = self.store.current([TABLE, WAITING])
        if TABLE not in held:
            # Published even when nothing came yet, so that the table can be read.
            through = -1 if last is None else last
            self._append(latest_per_key(landed, PAYMENT_KEY), through, held)
        elif last is not None:
            waiting = self.store.open(WAITING, held[WAITING])
            fresh = latest_per_key(landed.unionByName(waiting), PAYMENT_KEY)
            self._append(self.unheld(self.landing.settle(fresh, last), held[TABLE]), last, held)

    def unheld(self, fresh: DataFrame, table: Current) -> DataFrame:
        """Those of some stored payments that the table doesn't hold."""
        again = self.held_keys(fresh, table).join(
            broadcast_if_small(fresh.select(*PAYMENT_KEY)), list(PAYMENT_KEY), "left_semi"
        )
        return fresh.join(again, list(PAYMENT_KEY), "left_anti")

    def held_keys(self, fresh: DataFrame, table: Current) -> DataFrame:
        """The keys held in the buckets of some payments."""
        touched = touched_parts(table, fresh, self._layout(table))
        return self.store.open(TABLE, table, touched).select(*PAYMENT_KEY)

    def _layout(self, table: Current | None) -> Layout:
        return Layout.by_bucket(PAYMENT_KEY, self.buckets if table is None else table.buckets)

    def _append(self, fresh: DataFrame, through: int, held: dict[str, Current]) -> None:
        known = payers(self.customers()).withColumn("known", F.lit(True))
        rows = fresh.join(known, "customer_number", "left")
        run_id = self.landing.run_id(through)
        # the rows are read more than once: to see their buckets, to write them, to let the others wait
        joined = self.landing.settle(rows, through, "joined")
        part = joined.where("known").select(*payment_columns(self.loaded_at, self.keys))
        layout = self._layout(held.get(TABLE))
        if TABLE in held:
            appended = self.store.stage_appended(
                run_id, TABLE, held[TABLE], part, layout, self.most_parts
            )
        else:
            appended = self.store.stage_parts(run_id, TABLE, part, layout)
        waiting = joined.where(F.col("known").isNull()).select(*PAYMENT_KEY, "payment_date", "amount")
        versions = {name: held[name].path if name in held else None for name in (TABLE, WAITING)}
        self.landing.publish(through, [appended, *self.store.stage(run_id, {WAITING: waiting})], versions)

    def read(self) -> DataFrame:
        return without_layout(self.store.read(TABLE))

    def waiting(self) -> DataFrame:
        """Payments without a known customer as of the last run."""
        return self.store.read(WAITING)
