"""The whole warehouse from the source tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import KeyScheme
from ledgerloom.operators import audit
from ledgerloom.operators.branches import Branches, expected
from ledgerloom.operators.dimensions import (
    dim_customer,
    dim_date,
    dim_employee,
    dim_office,
    dim_product,
)
from ledgerloom.operators.facts import (
    ORDER_YEAR,
    PAYMENT_YEAR,
    fact_order_sales,
    fact_payments,
    recomputed_sales_columns,
    sales_columns,
    sold_lines,
)
from ledgerloom.sinks.warehouse import Layout, Warehouse, Written


@dataclass(frozen=True)
class WarehouseTable:
    """A table of the warehouse: the source tables it reads, in order, and its operator.

    ``joined`` and ``columns`` are the two halves of an operator whose columns are computed after its rows have
    been gathered for the write.
    """

    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    has_load_time: bool = True
    counts_joins: bool = False
    joined: Callable[..., DataFrame] | None = None
    columns: Callable[..., list[Column]] | None = None


# The warehouse tables, dimensions first.
TABLES = {
    "dim_customer": WarehouseTable(("customers",), dim_customer),
    "dim_product": WarehouseTable(("products", "productlines"), dim_product),
    "dim_employee": WarehouseTable(("employees",), dim_employee),
    "dim_office": WarehouseTable(("offices",), dim_office),
    "dim_date": WarehouseTable(("orders", "payments"), dim_date, has_load_time=False),
    "fact_order_sales": WarehouseTable(
        ("orderdetails", "orders", "customers", "products", "employees"),
        fact_order_sales,
        counts_joins=True,
        joined=sold_lines,
        columns=sales_columns,
    ),
    "fact_payments": WarehouseTable(("payments", "customers"), fact_payments, counts_joins=True),
}

# Dimensions with a hashed key: natural and surrogate key columns.
HASHED_KEYS = {
    "dim_customer": ("customer_number", "customer_key"),
    "dim_product": ("product_code", "product_key"),
    "dim_employee": ("employee_number", "employee_key"),
    "dim_office": ("office_code", "office_key"),
}


def layouts() -> dict[str, Layout]:
    """How stored tables are cut into partitions: facts by year; a fact without a date goes to year 0."""

    def by_year(column: str, day: str, finish=None) -> Layout:
        return Layout(column, F.coalesce(F.year(day), F.lit(0)), finish=finish)

    return {
        "fact_order_sales": by_year(ORDER_YEAR, "order_date", recomputed_sales_columns),
        "fact_payments": by_year(PAYMENT_YEAR, "payment_date"),
    }


def inputs_of(*names: str) -> tuple[str, ...]:
    """The source tables that some warehouse tables read together."""
    return tuple(dict.fromkeys(i for name in names for i in TABLES[name].inputs))


def load_time(moment: datetime) -> Column:
    """One load time for a whole run, as a literal; the moment should know its time zone."""
    return F.lit(moment).cast("timestamp")


def build_table(
    name: str,
    sources: Mapping[str, DataFrame],
    loaded_at: Column,
    keys: KeyScheme = KeyScheme.XXHASH64,
    branches: Branches | None = None,
) -> DataFrame:
    """One warehouse table, as a plan; nothing runs but the size check of a broadcast.

    ``branches`` makes a fact count the rows that its joins drop.
    """
    table = TABLES[name]
    frames = [sources[i] for i in table.inputs]
    if not table.has_load_time:
        return table.build(*frames)
    counting = {"branches": branches} if table.counts_joins else {}
    return table.build(*frames, loaded_at, keys, **counting)


def for_writing(
    name: str,
    sources: Mapping[str, DataFrame],
    loaded_at: Column,
    keys: KeyScheme = KeyScheme.XXHASH64,
    branches: Branches | None = None,
) -> tuple[DataFrame, Layout | None]:
    """Rows that give a warehouse table once they are written with the layout.

    Where the operator has two halves, these are the joined rows: narrower than the table, and all that is shuffled
    to gather its partitions.
    """
    table, layout = TABLES[name], layouts().get(name)
    if layout is None or table.joined is None:
        return build_table(name, sources, loaded_at, keys, branches), layout
    rows = table.joined(*[sources[i] for i in table.inputs], branches=branches)
    return rows, replace(layout, finish=lambda _: table.columns(loaded_at, keys))


def build_all(
    sources: Mapping[str, DataFrame],
    loaded_at: Column,
    keys: KeyScheme = KeyScheme.XXHASH64,
) -> dict[str, DataFrame]:
    return {name: build_table(name, sources, loaded_at, keys) for name in TABLES}


def stage_all(
    store: Warehouse,
    run_id: str,
    sources: Mapping[str, DataFrame],
    loaded_at: Column,
    keys: KeyScheme = KeyScheme.XXHASH64,
    names: Iterable[str] = tuple(TABLES),
) -> list[Written]:
    """Write warehouse tables; facts come with what their joins counted, as metrics.

    Counts that do not give the rows written are left out, so that audits count from the sources.
    """
    branches = {name: Branches() for name in names if TABLES[name].counts_joins}
    tables = {n: for_writing(n, sources, loaded_at, keys, branches.get(n)) for n in names}
    rows = {n: df for n, (df, _) in tables.items()}
    cut = {n: layout for n, (_, layout) in tables.items() if layout is not None}
    return [
        replace(w, metrics=branches[w.name].agreed(w.rows)) if w.name in branches else w
        for w in store.stage(run_id, rows, cut)
    ]


def counted_rows(metrics: Mapping[str, Mapping[str, int] | None]) -> dict[str, int]:
    """The rows that tables should have by the metrics kept with them, where there are any."""
    found = {name: expected(counts or {}) for name, counts in metrics.items()}
    return {name: rows for name, rows in found.items() if rows is not None}


def verify(
    sources: Mapping[str, DataFrame],
    stored: Mapping[str, DataFrame],
    recount: bool = True,
    counted: Mapping[str, int] | None = None,
) -> None:
    """Raise unless the written tables are complete, collision-free and consistent.

    Without ``recount`` the rows that the sources should give are not counted again, nor are those of
    tables in ``counted``, whose joins counted them.
    """
    if recount:
        audit.require_all(
            audit.target_counts(sources, stored, counted), ~F.col("matches"), "row counts differ"
        )
    audit.require_all(
        audit.key_collisions({n: (stored[n], *HASHED_KEYS[n]) for n in HASHED_KEYS}),
        F.col("colliding_keys") > 0,
        "surrogate keys collide",
    )
    # A customer may name a representative nobody knows: that key is allowed to point nowhere.
    audit.require_all(
        audit.fact_dim_integrity(stored).where(F.col("fact_column") != "sales_rep_employee_key"),
        F.col("stray_rows") > 0,
        "facts point to missing dimension rows",
    )
