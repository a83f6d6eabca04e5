"""The sales fact kept in step with its bronze tables, line by line.

What changed is found by comparing two versions of the bronze tables, in the buckets that were written in between. A
changed order, customer or representative affects the lines of its orders, a changed product its own lines. Only
affected lines are joined again; the others are copied, and only where they share a partition with an affected
one. Partitions without any are not read for the copy, and their files stay.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import KeyScheme, hash_key
from ledgerloom.operators.facts import ORDER_YEAR, fact_order_sales
from ledgerloom.operators.marks import Keys, having_any, lacking_all, marks_of
from ledgerloom.operators.sizing import broadcast_or_shuffle, is_small
from ledgerloom.operators.sync import live, snapshot_diff
from ledgerloom.plans.warehouse import TABLES, layouts
from ledgerloom.sinks.warehouse import BUCKET, Current, Warehouse, Written

FACT = "fact_order_sales"
SCHEME = "key_scheme"
# What the fact reads of each table: its key, then the columns that matter.
_KEYS = {
    "orderdetails": ("order_number", "product_code"),
    "orders": ("order_number",),
    "customers": ("customer_number",),
    "products": ("product_code",),
    "employees": ("employee_number",),
}
_USED = {
    "orderdetails": ("quantity_ordered", "price_each", "order_line_number"),
    "orders": ("order_date", "required_date", "shipped_date", "status", "customer_number"),
    "customers": ("sales_rep_employee_number",),
    "products": ("buy_price", "msrp"),
    "employees": ("office_code",),
}


def inputs_with_scheme(inputs: Mapping[str, str], keys: KeyScheme) -> dict[str, str]:
    """What a build leaves for a refresh: the bronze versions and the key scheme."""
    return {**inputs, SCHEME: keys.value}


def refreshable(store: Warehouse, keys: KeyScheme = KeyScheme.XXHASH64) -> bool:
    """Whether there is a sales fact that is known to be made from bronze versions, with these keys."""
    if not store.exists(FACT):
        return False
    made_from = store.made_from(FACT)
    return set(TABLES[FACT].inputs) <= set(made_from) and made_from.get(SCHEME) == keys.value


def changed_keys(store: Warehouse, name: str, before: Current, after: Current) -> DataFrame | None:
    """Keys whose used columns differ between two versions of a bronze table; None without any new part."""
    touched = after.touched_since(before)
    if not touched:
        return None
    columns = [*_KEYS[name], *_USED[name]]
    old, new = (
        live(store.open(name, version, touched).drop(BUCKET)).select(*columns)
        for version in (before, after)
    )
    diff = snapshot_diff(old, new, _KEYS[name])
    return diff.where(F.col("change_type") != "unchanged").drop("change_type")


def affected(
    store: Warehouse, before: Mapping[str, Current], after: Mapping[str, Current], run_id: str
) -> tuple[DataFrame, DataFrame]:
    """Numbers of the orders and codes of the products whose lines may differ, as written tables."""
    sources = {n: live(store.open(n, version).drop(BUCKET)) for n, version in after.items()}
    found = {n: changed_keys(store, n, before[n], after[n]) for n in after}
    written = store.stage(f"{run_id}-changes", {n: keys for n, keys in found.items() if keys is not None})
    changed = {w.name: store.read_written(w) for w in written}
    buyers = [changed["customers"]] if "customers" in changed else []
    if "employees" in changed:
        reps = changed["employees"].select(F.col("employee_number").alias("sales_rep_employee_number"))
        customers = sources["customers"].select("customer_number", "sales_rep_employee_number")
        of_reps = customers.join(broadcast_or_shuffle(reps), "sales_rep_employee_number", "left_semi")
        buyers.append(of_reps.select("customer_number"))
    numbers = [changed[n].select("order_number") for n in ("orders", "orderdetails") if n in changed]
    if buyers:
        buyer = reduce(DataFrame.unionByName, buyers).distinct()
        buyer = store.read_written(store.stage(f"{run_id}-buyers", {"buyers": buyer})[0])
        orders = sources["orders"].select("order_number", "customer_number")
        of_buyers = orders.join(broadcast_or_shuffle(buyer), "customer_number", "left_semi")
        numbers.append(of_buyers.select("order_number"))
    none = {n: sources[n].select(*_KEYS[n]).limit(0) for n in ("orders", "products")}
    distinct = reduce(DataFrame.unionByName, numbers, none["orders"]).distinct()
    orders_written = store.stage(f"{run_id}-affected", {"orders": distinct})[0]
    return store.read_written(orders_written), changed.get("products", none["products"])


def keys_to_join(store: Warehouse, run_id: str, keys: DataFrame) -> Keys:
    """Distinct keys with the way they are to be joined, measured once: broadcast, or shuffled behind their marks."""
    if is_small(keys):
        return Keys(F.broadcast(keys))
    written = store.stage(f"{run_id}-marks", {keys.columns[0]: marks_of(keys)})[0]
    return Keys(keys.hint("merge"), store.read_written(written))


def untouched(fact: DataFrame, *affected_keys: DataFrame | Keys) -> DataFrame:
    """Stored lines that no change can reach; nothing is joined to them."""
    sets = [keys if isinstance(keys, Keys) else Keys(keys) for keys in affected_keys]
    return lacking_all(fact, *sets)


def refresh_order_sales(
    store: Warehouse,
    run_id: str,
    inputs: Mapping[str, str],
    loaded_at: Column,
    keys: KeyScheme = KeyScheme.XXHASH64,
) -> Written:
    """Partitions of the sales fact as of the given bronze versions, staged and not published yet.

    ``keys`` must be the scheme that the stored fact was built with. Lines keep their load time unless they are
    affected. Products are matched by their hashed key on both sides, so keys that collide are refreshed together.
    """
    names = TABLES[FACT].inputs
    since = store.made_from(FACT)
    before, after = (store.current(names, at={n: at[n] for n in names}) for at in (since, inputs))
    sources = {n: live(store.open(n, after[n]).drop(BUCKET)) for n in names}
    orders, codes = affected(store, before, after, run_id)
    products = codes.select(hash_key(F.col("product_code"), keys).alias("product_key")).distinct()
    # a set that is shuffled comes last, so that it meets the rows that the other one left
    sets = sorted((keys_to_join(store, run_id, k) for k in (orders, products)), key=lambda k: k.marks is not None)

    held = store.current([FACT])[FACT]
    stored = store.open(FACT, held).select(ORDER_YEAR, "order_number", "product_key")
    gone = having_any(stored, *sets)

    details = sources["orderdetails"].withColumn("product_key", hash_key(F.col("product_code"), keys))
    lines = having_any(details, *sets).drop("product_key")
    wanted = {**sources, "orderdetails": lines}
    new = fact_order_sales(*(wanted[n] for n in names), loaded_at, keys)
    layout = layouts()[FACT]
    new_written = store.stage(f"{run_id}-lines", {"lines": new.withColumn(ORDER_YEAR, layout.value)})[0]
    new = store.read_written(new_written)

    # as many rows as the fact has years
    years = gone.select(ORDER_YEAR).unionByName(new.select(ORDER_YEAR)).distinct().collect()
    values = sorted(str(r[0]) for r in years)
    kept = untouched(store.open(FACT, held, values), *sets)
    return store.stage_parts(run_id, FACT, kept.unionByName(new), layout, values)
