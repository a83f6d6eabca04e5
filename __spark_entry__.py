"""Registered queries: every operator of the library over the given tables, with SQL oracles."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from ledgerloom.functions import (  # noqa: E402
    KeyScheme,
    cost_amount,
    gross_amount,
    hash_key,
    margin_amount,
    nullable_hash_key,
)
from ledgerloom.operators import audit, dimensions, facts, sync  # noqa: E402
from ledgerloom.plans import jobs, reports, warehouse  # noqa: E402
from ledgerloom.plans.refresh import FACT, refresh_order_sales  # noqa: E402
from ledgerloom.session import (  # noqa: E402
    fingerprint,
    new_folder,
    scoped_session,
    shared_folder,
    stored_bytes,
)
from ledgerloom.sinks.names import listed_tables, register_tables  # noqa: E402
from ledgerloom.sinks.warehouse import Warehouse  # noqa: E402
from ledgerloom.sources import SOURCES, retail  # noqa: E402
from ledgerloom.sources.files import register_views  # noqa: E402
from ledgerloom.streaming.changes import run_upserts  # noqa: E402
from ledgerloom.streaming.files import table_stream  # noqa: E402
from ledgerloom.streaming.payments import PaymentsFeed, current_payments  # noqa: E402

try:  # the subpackage is optional: without it, its queries are left out
    import corpus_pipeline
    from ledgerloom.llm.oracles import ORACLES as LLM_ORACLES
    from ledgerloom.llm.queries import QUERIES as LLM_QUERIES
    from ledgerloom.llm.queries import TABLES as LLM_TABLES
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "ledgerloom.llm"):
        raise
    LLM_QUERIES, LLM_TABLES, LLM_ORACLES = {}, {}, {}
else:
    LLM_QUERIES = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}
    LLM_TABLES = {**LLM_TABLES, "pipeline": ("documents", "benchmark")}
    if corpus_pipeline.ORACLE_SQL:
        LLM_ORACLES = {**LLM_ORACLES, "pipeline": corpus_pipeline.ORACLE_SQL}

SMOKE_DIR = "/root/testdata/sf0.001"
# Noon, so that the day is the same in the session's time zone.
FIRST, SECOND, THIRD = (datetime(2024, 1, day, 12, tzinfo=timezone.utc) for day in (1, 2, 3))
# The last day of the first of two deliveries of payments.
REDELIVERED_FROM = date(2024, 1, 15)
SOURCE_KEYS = {name: table.primary_key for name, table in SOURCES.items()}
CUSTOMER_KEY = SOURCE_KEYS["customers"]
CUSTOMER_COLUMNS = (
    "customer_number",
    "customer_name",
    "country",
    "sales_rep_employee_number",
    "credit_limit",
)

Query = Callable[[SparkSession, str], DataFrame]


# --- warehouse tables: key values as in existing warehouses ------------------------------


def _table(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = warehouse.build_table(
            name,
            retail.load_sources(spark, sf_dir, warehouse.inputs_of(name)),
            warehouse.load_time(FIRST),
            KeyScheme.MURMUR32,
        )
        return table.drop("etl_loaded_at")

    return query


# --- sources and single operators ----------------------------------------------------------


def src_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.row_counts(retail.load_sources(spark, sf_dir))


def src_sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = retail.load_sources(spark, sf_dir, ("orders", "customers"))
    register_views(sources, prefix="ledgerloom_")
    return spark.sql(
        """SELECT country, status, count(*) AS order_count
           FROM ledgerloom_orders JOIN ledgerloom_customers USING (customer_number)
           GROUP BY country, status"""
    )


def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.date_bounds(retail.orders(spark, sf_dir), retail.payments(spark, sf_dir))


def filter_not_cancelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.not_cancelled(retail.orders(spark, sf_dir)).select("order_number", "status")


def left_join_unmatched_rep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.with_rep_office(
        retail.customers(spark, sf_dir), retail.employees(spark, sf_dir)
    ).select("customer_number", "sales_rep_employee_number", "rep_office_code")


def scalar_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.orders(spark, sf_dir).select(
        "order_number", *dimensions.calendar_columns(F.col("order_date"))
    )


def scalar_concat_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipment = F.concat(
        F.col("order_number").cast("string"), F.lit("-"), F.col("shipped_date").cast("string")
    )
    return retail.orders(spark, sf_dir).select("order_number", shipment.alias("shipment_id"))


def scalar_line_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity, price, cost = (F.col(c) for c in ("quantity_ordered", "price_each", "buy_price"))
    products = retail.products(spark, sf_dir).select("product_code", "buy_price")
    return (
        retail.orderdetails(spark, sf_dir)
        .join(products, "product_code")
        .select(
            "order_number",
            "order_line_number",
            "product_code",
            gross_amount(quantity, price).alias("gross_sales_amount"),
            cost_amount(quantity, cost).alias("cost_amount"),
            margin_amount(quantity, price, cost).alias("margin_amount"),
        )
    )


def _order_keys(scheme: KeyScheme) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return retail.orders(spark, sf_dir).select(
            "order_number", hash_key(F.col("order_number"), scheme).alias("order_key")
        )

    return query


def hash_key_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of a text column, as the products of a database have them, in both schemes."""
    line = F.col("product_line")
    return retail.products(spark, sf_dir).select(
        "product_code",
        nullable_hash_key(line, KeyScheme.MURMUR32).alias("narrow_key"),
        nullable_hash_key(line, KeyScheme.XXHASH64).alias("wide_key"),
    )


# --- the written warehouse -----------------------------------------------------------------

_built: dict[tuple[str, str, str, int], str] = {}


def _build(spark: SparkSession, sf_dir: str) -> Warehouse:
    store = Warehouse(spark, new_folder(spark, "warehouse"))
    sources = retail.load_sources(spark, sf_dir)
    written = warehouse.stage_all(store, "build", sources, warehouse.load_time(FIRST))
    store.publish("build", written)
    return store


def _stored(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of these tables: written once per application for the files they have now."""
    files = fingerprint(spark, *retail.raw_paths(sf_dir))
    key = (spark.sparkContext.applicationId, shared_folder(spark), sf_dir, files)
    if key not in _built:
        _built[key] = _build(spark, sf_dir).root
    return Warehouse(spark, _built[key])


def _stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _stored(spark, sf_dir).read_all(*warehouse.TABLES)


def build_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _build(spark, sf_dir)
    return audit.row_counts(store.read_all(*warehouse.TABLES))


def list_warehouse_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _stored(spark, sf_dir)
    register_tables(store, prefix="stored_")
    return listed_tables(store, prefix="stored_")


def report_by_table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by year and country as a user asks for it in SQL, over the tables' names."""
    register_tables(_stored(spark, sf_dir), STAR)
    return spark.sql(
        """SELECT d.calendar_year, c.country, sum(f.gross_sales_amount) AS gross_revenue
           FROM fact_order_sales f
           JOIN dim_date d ON f.order_date_key = d.date_key
           JOIN dim_customer c USING (customer_key)
           JOIN dim_product p USING (product_key)
           GROUP BY d.calendar_year, c.country"""
    )


def stored_fact_order_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales fact as the warehouse holds it, with the wide keys of a default build."""
    return _stored(spark, sf_dir).read("fact_order_sales").drop("etl_loaded_at", facts.ORDER_YEAR)


def sink_overwrite_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Warehouse(spark, new_folder(spark, "sink"))
    table = _table("dim_customer")(spark, sf_dir)
    for run in ("first", "second"):
        store.replace(run, {"dim_customer": table})
    return store.read("dim_customer")


# --- reports over the written warehouse ----------------------------------------------------

STAR = ("fact_order_sales", "dim_date", "dim_customer", "dim_product")


def report_revenue_month_country_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _stored(spark, sf_dir).read_all(*STAR)
    return reports.revenue_by_month_country_line(*[tables[name] for name in STAR])


def report_revenue_recent_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _stored(spark, sf_dir).read_all(*STAR)
    return reports.revenue_recent_first(*[tables[name] for name in STAR])


def report_revenue_one_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue of the days of one year; other years of the stored fact are not read."""
    tables = _stored(spark, sf_dir).read_all(*STAR)
    first, last = date(1995, 1, 1), date(1995, 12, 31)
    return reports.revenue_between(*[tables[name] for name in STAR], first, last)


def report_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _stored(spark, sf_dir).read_all("fact_order_sales", "dim_customer")
    return reports.top_customers(tables["fact_order_sales"], tables["dim_customer"])


# --- audits --------------------------------------------------------------------------------


def audit_target_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _stored(spark, sf_dir)
    counted = warehouse.counted_rows({name: store.metrics(name) for name in warehouse.TABLES})
    stored = store.read_all(*warehouse.TABLES)
    return audit.target_counts(retail.load_sources(spark, sf_dir), stored, counted)


def audit_pk_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = retail.load_sources(spark, sf_dir)
    return audit.key_uniqueness({name: (df, SOURCE_KEYS[name]) for name, df in sources.items()})


def audit_fact_dim_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.fact_dim_integrity(_stored_tables(spark, sf_dir))


def audit_key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    natural = {}
    for name, (key, _) in warehouse.HASHED_KEYS.items():
        source = warehouse.TABLES[name].inputs[0]
        rows = retail.load_sources(spark, sf_dir, (source,))[source]
        natural[name] = rows.select(F.col(key).alias("natural"))

    def collisions(scheme: KeyScheme) -> DataFrame:
        keyed = {
            name: (
                df.withColumn("surrogate", hash_key(F.col("natural"), scheme)),
                "natural",
                "surrogate",
            )
            for name, df in natural.items()
        }
        return audit.key_collisions(keyed).withColumn("key_scheme", F.lit(scheme.value))

    return collisions(KeyScheme.MURMUR32).unionByName(collisions(KeyScheme.XXHASH64))


def audit_report_reconciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = report_revenue_month_country_line(spark, sf_dir)
    return audit.report_reconciles(report, _stored(spark, sf_dir).read("fact_order_sales"))


# --- sync ----------------------------------------------------------------------------------


def _changed(customer: DataFrame) -> DataFrame:
    """Raw customers after a source change: one segment has more credit, one none on record."""
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal").cast("decimal(12,2)")
    return customer.withColumn(
        "c_acctbal",
        F.when(segment == "BUILDING", balance + 1).when(segment != "HOUSEHOLD", balance),
    )


def _old_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return retail.customers_from(
        customer.where(F.col("c_mktsegment") != "MACHINERY"), retail.nations(spark, sf_dir)
    ).select(*CUSTOMER_COLUMNS)


def _new_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return retail.customers_from(
        _changed(customer.where(F.col("c_acctbal") >= 0)), retail.nations(spark, sf_dir)
    ).select(*CUSTOMER_COLUMNS)


def _synced_in() -> Column:
    """Which of the syncs last touched a row."""
    day = F.dayofmonth("synced_at")
    return F.when(day == 1, "first").when(day == 2, "second").otherwise("third").alias("synced_in")


def _synced_customers(spark: SparkSession, sf_dir: str, syncs: int) -> DataFrame:
    """Bronze customers after the old, the new and again the old snapshot, as many as asked."""
    store = Warehouse(spark, new_folder(spark, "bronze"))
    steps = (
        ("first", FIRST, _old_customers),
        ("second", SECOND, _new_customers),
        ("third", THIRD, _old_customers),
    )
    for run, moment, snapshot in steps[:syncs]:
        snapshots = {"customers": snapshot(spark, sf_dir)}
        sync.sync_tables(store, snapshots, SOURCE_KEYS, warehouse.load_time(moment), run)
    return store.read("customers")


def sync_initial_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _synced_customers(spark, sf_dir, 1)
    return bronze.select(*CUSTOMER_COLUMNS, "is_deleted", _synced_in())


def sync_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.snapshot_diff(
        _old_customers(spark, sf_dir), _new_customers(spark, sf_dir), CUSTOMER_KEY
    )


def sync_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _synced_customers(spark, sf_dir, 2)
    return bronze.select(*CUSTOMER_COLUMNS, "is_deleted", _synced_in())


def sync_soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _synced_customers(spark, sf_dir, 3)
    return bronze.select("customer_number", "is_deleted", _synced_in())


def _changed_sources(
    spark: SparkSession, sf_dir: str, sources: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Dearer products and deleted orders at the source."""
    products = sources["products"]
    dearer = products.withColumn(
        "buy_price",
        F.when(F.col("product_vendor") == "Brand#1", F.col("buy_price") + 1)
        .otherwise(F.col("buy_price"))
        .cast("decimal(10,2)"),
    )
    kept = spark.read.parquet(f"{sf_dir}/orders.parquet").where(
        F.col("o_orderpriority") != "5-LOW"
    )
    return {"products": dearer, "orders": retail.orders_from(kept)}


REBUILT = (
    "sales_line_id", "order_line_number", "quantity_ordered", "price_each", "buy_price",
    "gross_sales_amount", "cost_amount", "margin_amount",
)


def sync_then_rebuild_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dearer products and deleted orders at the source change the rebuilt sales fact."""
    store = Warehouse(spark, new_folder(spark, "bronze"))
    sources = retail.load_sources(spark, sf_dir, warehouse.inputs_of("fact_order_sales"))
    new = _changed_sources(spark, sf_dir, sources)
    old = {name: sources[name] for name in new}
    sync.sync_tables(store, old, SOURCE_KEYS, warehouse.load_time(FIRST), "first")
    sync.sync_tables(store, new, SOURCE_KEYS, warehouse.load_time(SECOND), "second")
    sources |= {name: sync.live(df) for name, df in store.read_all(*new).items()}
    fact = warehouse.build_table("fact_order_sales", sources, warehouse.load_time(SECOND))
    return fact.select(*REBUILT)


def sync_then_refresh_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes, with only the lines they affect joined again."""
    store = Warehouse(spark, new_folder(spark, "bronze"))
    names = warehouse.inputs_of("fact_order_sales")
    sources = retail.load_sources(spark, sf_dir, names)
    first, second = (warehouse.load_time(moment) for moment in (FIRST, SECOND))
    # lines of the given tables repeat their key, so they are no bronze table that could be merged
    store.replace("lines", {"orderdetails": sync.initial_load(sources.pop("orderdetails"), first)})
    sync.sync_tables(store, sources, SOURCE_KEYS, first, "first")
    inputs = store.paths(names)
    built = warehouse.stage_all(store, "first-build", jobs.bronze_sources(store, inputs), first, names=[FACT])
    store.publish("first-build", built, None, inputs)
    sync.sync_tables(store, _changed_sources(spark, sf_dir, sources), SOURCE_KEYS, second, "second")
    inputs = store.paths(names)
    refreshed = refresh_order_sales(store, "second-build", inputs, second)
    store.publish("second-build", [refreshed], None, inputs)
    return store.read(FACT).select(*REBUILT)


# --- streams -------------------------------------------------------------------------------


def stream_fact_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "payments")
    feed = PaymentsFeed(
        Warehouse(spark, folder),
        f"{folder}/feed",
        lambda: retail.customers(spark, sf_dir),
        warehouse.load_time(FIRST),
        KeyScheme.MURMUR32,
    )
    feed.run(retail.payments_from(table_stream(spark, f"{sf_dir}/events.parquet")))
    return feed.read().drop("etl_loaded_at")


def stream_payments_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments up to a day fed first, then all of them from another folder: each is held once."""
    folder = new_folder(spark, "payments")
    store = Warehouse(spark, folder)
    payments = retail.payments_from(table_stream(spark, f"{sf_dir}/events.parquet"))
    early = payments.where(F.col("payment_date") <= F.lit(REDELIVERED_FROM))
    for delivery, rows in (("first", early), ("again", payments)):
        feed = PaymentsFeed(
            store,
            f"{folder}/feed-{delivery}",
            lambda: retail.customers(spark, sf_dir),
            warehouse.load_time(FIRST),
            KeyScheme.MURMUR32,
        )
        feed.run(rows)
    return feed.read().drop("etl_loaded_at")


def stream_then_build_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payments fed, then built in full: together they hold each payment once."""
    folder = new_folder(spark, "payments")
    store = Warehouse(spark, folder)
    feed = PaymentsFeed(
        store,
        f"{folder}/feed",
        lambda: retail.customers(spark, sf_dir),
        warehouse.load_time(FIRST),
        KeyScheme.MURMUR32,
    )
    feed.run(retail.payments_from(table_stream(spark, f"{sf_dir}/events.parquet")))
    sources = retail.load_sources(spark, sf_dir, warehouse.inputs_of("fact_payments"))
    built = warehouse.build_table(
        "fact_payments", sources, warehouse.load_time(SECOND), KeyScheme.MURMUR32
    )
    store.replace("build", {"fact_payments": built}, warehouse.layouts())
    return current_payments(store).drop("etl_loaded_at")


def stream_customer_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers loaded, then two segments fed again as changed rows."""
    folder = new_folder(spark, "upserts")
    store = Warehouse(spark, folder)
    customers = retail.customers(spark, sf_dir).select(*CUSTOMER_COLUMNS)
    loaded_at = warehouse.load_time(FIRST)
    sync.sync_tables(store, {"customers": customers}, SOURCE_KEYS, loaded_at, "first")
    feed = table_stream(spark, f"{sf_dir}/customer.parquet")
    changed = retail.customers_from(
        _changed(feed.where(F.col("c_mktsegment").isin("MACHINERY", "BUILDING"))),
        retail.nations(spark, sf_dir),
    ).select(*CUSTOMER_COLUMNS)
    run_upserts(changed, store, "customers", CUSTOMER_KEY, f"{folder}/feed")
    return sync_columns(store.read("customers"), loaded_at)


def sync_columns(bronze: DataFrame, loaded_at: Column) -> DataFrame:
    """Live rows and whether they came from the feed rather than the first load."""
    return bronze.where(~F.col("is_deleted")).select(
        *CUSTOMER_COLUMNS, (F.col("synced_at") != loaded_at).alias("from_feed")
    )


# --- contract ------------------------------------------------------------------------------


_input_bytes: dict[tuple[str, str], int] = {}


def _fitted(query: Query, paths: Callable[[str], list[str]]) -> Query:
    """The query, run in a session of its own with shuffles sized for its tables; they are listed once."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = paths(sf_dir)
        key = (spark.sparkContext.applicationId, ",".join(tables))
        if key not in _input_bytes:
            _input_bytes[key] = stored_bytes(spark, *tables)
        return query(scoped_session(spark, _input_bytes[key]), sf_dir)

    return run


def _corpus_paths(name: str) -> Callable[[str], list[str]]:
    return lambda sf_dir: [f"{sf_dir}/{table}.parquet" for table in LLM_TABLES[name]]


def entry(spark: SparkSession) -> DataFrame:
    """Revenue by month, country and product line."""
    return queries()["report_revenue_month_country_line"](spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    own = {name: _fitted(query, retail.raw_paths) for name, query in _QUERIES.items()}
    return own | {name: _fitted(query, _corpus_paths(name)) for name, query in LLM_QUERIES.items()}


_QUERIES: dict[str, Query] = {
    "src_table_counts": src_table_counts,
    "src_sql_view": src_sql_view,
    **{name: _table(name) for name in warehouse.TABLES},
    "date_bounds": date_bounds,
    "filter_not_cancelled": filter_not_cancelled,
    "left_join_unmatched_rep": left_join_unmatched_rep,
    "scalar_date_parts": scalar_date_parts,
    "scalar_concat_null": scalar_concat_null,
    "scalar_line_amounts": scalar_line_amounts,
    "hash_key_murmur": _order_keys(KeyScheme.MURMUR32),
    "hash_key_wide": _order_keys(KeyScheme.XXHASH64),
    "hash_key_text": hash_key_text,
    "report_revenue_month_country_line": report_revenue_month_country_line,
    "report_revenue_recent_first": report_revenue_recent_first,
    "report_revenue_one_year": report_revenue_one_year,
    "report_top_customers": report_top_customers,
    "report_by_table_names": report_by_table_names,
    "build_warehouse": build_warehouse,
    "list_warehouse_tables": list_warehouse_tables,
    "stored_fact_order_sales": stored_fact_order_sales,
    "sink_overwrite_idempotent": sink_overwrite_idempotent,
    "audit_target_counts": audit_target_counts,
    "audit_pk_unique": audit_pk_unique,
    "audit_fact_dim_integrity": audit_fact_dim_integrity,
    "audit_key_collisions": audit_key_collisions,
    "audit_report_reconciles": audit_report_reconciles,
    "sync_initial_load": sync_initial_load,
    "sync_snapshot_diff": sync_snapshot_diff,
    "sync_merge": sync_merge,
    "sync_soft_delete": sync_soft_delete,
    "sync_then_rebuild_fact": sync_then_rebuild_fact,
    "sync_then_refresh_fact": sync_then_refresh_fact,
    "stream_fact_payments": stream_fact_payments,
    "stream_payments_redelivered": stream_payments_redelivered,
    "stream_then_build_payments": stream_then_build_payments,
    "stream_customer_upsert": stream_customer_upsert,
}


def oracle_sql() -> dict[str, str]:
    return oracles.build() | LLM_ORACLES
