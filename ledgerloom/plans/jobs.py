"""The jobs a scheduler starts: sync and build, feed, and report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.functions import KeyScheme
from ledgerloom.operators.sync import BUCKETS, live, sync_tables
from ledgerloom.plans import reports, warehouse
from ledgerloom.plans.refresh import FACT, inputs_with_scheme, refresh_order_sales, refreshable
from ledgerloom.sinks.jdbc import CONNECTIONS, ensure_schema, register_catalog, replace_table
from ledgerloom.sinks.warehouse import BUCKET, Warehouse
from ledgerloom.sources import SOURCES, conform
from ledgerloom.sources.jdbc import JdbcEndpoint
from ledgerloom.streaming.changes import run_upserts
from ledgerloom.streaming.files import DELIVERY, FILES_PER_BATCH, table_stream
from ledgerloom.streaming.payments import PaymentsFeed

CATALOG = "ledgerloom_target"


def land(store: Warehouse, snapshots: Mapping[str, DataFrame], run_id: str) -> dict[str, str]:
    """Read each source once and write it down; gives the landed table of each source."""
    landed = {name: f"landed_{name}" for name in snapshots}
    store.replace(f"{run_id}-landing", {landed[name]: df for name, df in snapshots.items()})
    return landed


def sync_landed(
    store: Warehouse, landed: Mapping[str, str], run_id: str, moment: datetime, buckets: int = BUCKETS
) -> dict[str, DataFrame]:
    """Bring the bronze tables in step with landed snapshots, give their live rows."""
    current = store.read_all(*landed.values())
    sync_tables(
        store,
        {name: current[table] for name, table in landed.items()},
        {name: SOURCES[name].primary_key for name in landed},
        warehouse.load_time(moment),
        run_id,
        buckets,
    )
    return bronze_sources(store, store.paths(list(landed)))


def sync_sources(
    store: Warehouse,
    snapshots: Mapping[str, DataFrame],
    run_id: str,
    moment: datetime,
    buckets: int = BUCKETS,
) -> dict[str, DataFrame]:
    """Land the snapshots, bring the bronze tables in step, give their live rows.

    Landing reads each source once; the key check and the merge then read the landed files, so
    they see the same rows even while the source changes.
    """
    return sync_landed(store, land(store, snapshots, run_id), run_id, moment, buckets)


def bronze_sources(store: Warehouse, versions: Mapping[str, str]) -> dict[str, DataFrame]:
    """The live rows of bronze tables as they were at some versions."""
    found = store.current(list(versions), at=versions)
    return {name: live(store.open(name, found[name]).drop(BUCKET)) for name in versions}


def build(
    store: Warehouse,
    sources: Mapping[str, DataFrame],
    run_id: str,
    moment: datetime,
    keys: KeyScheme = KeyScheme.XXHASH64,
    verify: bool = True,
    inputs: Mapping[str, str] | None = None,
) -> dict[str, int]:
    """Write all warehouse tables, check them as they were written, then publish them.

    If a check fails, or another build has published meanwhile, readers keep the tables they had. ``inputs``
    are the bronze versions that the sources stand for; a later ``refresh`` starts from them.

    Rows that the joins of the facts dropped were counted as they were written, so the checks do not
    read the order lines again unless those counts and the written rows disagree.
    """
    held = store.paths(list(warehouse.TABLES), other_than_run=run_id)
    written = warehouse.stage_all(store, run_id, sources, warehouse.load_time(moment), keys)
    if verify:
        stored = {w.name: store.read_written(w) for w in written}
        counted = warehouse.counted_rows({w.name: w.metrics for w in written})
        warehouse.verify(sources, stored, counted=counted)
    return store.publish(run_id, written, held, inputs and inputs_with_scheme(inputs, keys))


def build_from_bronze(
    store: Warehouse,
    run_id: str,
    moment: datetime,
    keys: KeyScheme = KeyScheme.XXHASH64,
    verify: bool = True,
) -> dict[str, int]:
    """Write all warehouse tables from the bronze tables as they are now."""
    inputs = store.paths(list(SOURCES))
    return build(store, bronze_sources(store, inputs), run_id, moment, keys, verify, inputs)


def refresh(
    store: Warehouse,
    run_id: str,
    moment: datetime,
    keys: KeyScheme = KeyScheme.XXHASH64,
    verify: bool = True,
) -> dict[str, int]:
    """Bring the warehouse in step with its bronze tables, doing no more to the sales fact than they changed.

    The sales fact is refreshed by ``refresh_order_sales``, all other tables are built anew. Without a sales
    fact of this key scheme whose bronze versions are known this is a full build. Gives the rows written.
    """
    if not refreshable(store, keys):
        return build_from_bronze(store, run_id, moment, keys, verify)
    inputs = store.paths(list(SOURCES))
    sources = bronze_sources(store, inputs)
    held = store.paths(list(warehouse.TABLES), other_than_run=run_id)
    loaded_at = warehouse.load_time(moment)
    others = {n: warehouse.build_table(n, sources, loaded_at, keys) for n in warehouse.TABLES if n != FACT}
    written = store.stage(run_id, others, warehouse.layouts())
    refreshed = refresh_order_sales(store, run_id, inputs, loaded_at, keys)
    if verify:
        stored = {w.name: store.read_written(w) for w in written} | {FACT: store.read_with(refreshed)}
        warehouse.verify(sources, stored, recount=False)
    return store.publish(run_id, [*written, refreshed], held, inputs_with_scheme(inputs, keys))


def copy_to_database(
    spark: SparkSession,
    store: Warehouse,
    endpoint: JdbcEndpoint,
    schema: str,
    connections: int = CONNECTIONS,
) -> dict[str, int]:
    """Replace the tables of a database schema by the current warehouse tables, each over at most
    ``connections`` connections."""
    register_catalog(spark, CATALOG, endpoint)
    ensure_schema(spark, CATALOG, schema)
    stored = store.read_all(*warehouse.TABLES)
    return {
        name: replace_table(df, endpoint, schema, name, connections=connections)
        for name, df in stored.items()
    }


def revenue_report(store: Warehouse) -> DataFrame:
    t = store.read_all("fact_order_sales", "dim_date", "dim_customer", "dim_product")
    return reports.revenue_by_month_country_line(*t.values())


def top_customers_report(store: Warehouse, k: int = reports.TOP_CUSTOMERS) -> DataFrame:
    t = store.read_all("fact_order_sales", "dim_customer")
    return reports.top_customers(*t.values(), k)


def feed_payments(store: Warehouse, path: str, moment: datetime) -> PaymentsFeed:
    """Append the new files of a parquet payments table, for the customers synced last."""
    feed = PaymentsFeed(
        store,
        f"{store.root}/feeds/payments",
        lambda: live(store.read("customers").drop(BUCKET)),
        warehouse.load_time(moment),
    )
    feed.run(conform(table_stream(store.spark, path), SOURCES["payments"]))
    return feed


def feed_changes(
    store: Warehouse,
    table: str,
    path: str,
    order_by: Sequence[str] = (),
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Upsert the new files of a parquet table of changed rows into its bronze table.

    Changes go by ``order_by``, columns of the table, then by delivery.
    """
    source = SOURCES[table]
    delivered = table_stream(store.spark, path, files_per_batch, with_delivery=True)
    changes = conform(delivered, source, DELIVERY)
    run_upserts(changes, store, table, source.primary_key, f"{store.root}/feeds/{table}", order_by)


def new_run_id(moment: datetime) -> str:
    return moment.astimezone(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
