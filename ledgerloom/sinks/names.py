"""Warehouse tables under their names in the session's catalog, for SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerloom.sinks.warehouse import Warehouse


def register_tables(store: Warehouse, names: Sequence[str] | None = None, prefix: str = "") -> list[str]:
    """Give the current versions of some tables, or of all, their names in the catalog of the store's session.

    All are looked up at one moment, so they belong together, and they stay as they are until this is
    called again: a report that takes several queries sees one state of the warehouse. Gives the names.
    """
    if names is None:
        names = [r["table_name"] for r in store.tables().select("table_name").collect()]
    found = store.current(names)
    missing = [n for n in names if n not in found]
    if missing:
        raise LookupError(f"no published table {', '.join(missing)} in {store.root}")
    for name in names:
        store.open(name, found[name]).createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in names]


def listed_tables(store: Warehouse, prefix: str = "") -> DataFrame:
    """The warehouse tables that the catalog has, with the rows they have now: ``table_name, row_count``."""
    catalog = store.spark.catalog
    held = {t.name for t in catalog.listTables()}
    rows = store.tables().select("table_name", "row_count").collect()  # a row for each table
    known = [(r["table_name"], r["row_count"]) for r in rows if f"{prefix}{r['table_name']}".lower() in held]
    return store.spark.createDataFrame(known, "table_name string, row_count bigint")
