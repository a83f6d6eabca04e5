from datetime import datetime, timezone

import pytest
import samples
from pyspark.sql import functions as F

import __spark_entry__ as registered
from ledgerloom.plans import jobs, warehouse
from ledgerloom.session import (
    INITIAL_PARTITIONS,
    PARTITION_BYTES,
    SCAN_BYTES,
    SHUFFLE_PARTITIONS,
    TIME_ZONE,
    Ceilings,
    bucket_count,
    fingerprint,
    fit_shuffles,
    new_folder,
    recommended_options,
    scoped_session,
    shared_folder,
    stored_bytes,
)
from ledgerloom.sinks.warehouse import Warehouse
from ledgerloom.sources.files import load_sources, register_views

MOMENT = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)


@pytest.fixture
def store(spark):
    return Warehouse(spark, new_folder(spark, "test"))


def numbers(store, name="t"):
    return sorted(r.id for r in store.read(name).collect())


def test_replace_replaces_and_counts(spark, store):
    assert store.replace("one", {"t": spark.range(3), "u": spark.range(0)}) == {"t": 3, "u": 0}
    assert store.replace("two", {"t": spark.range(2)}) == {"t": 2}
    assert numbers(store) == [0, 1]
    current = {r.table_name: (r.run_id, r.row_count) for r in store.tables().collect()}
    assert current == {"t": ("two", 2), "u": ("one", 0)}
    assert store.read("u").columns == ["id"]


def test_reading_past_a_run(spark, store):
    store.replace("one", {"t": spark.range(1)})
    store.replace("two", {"t": spark.range(2)})
    assert store.read("t", other_than_run="two").count() == 1


def test_failed_run_leaves_the_old_tables(spark, store):
    store.replace("one", {"t": spark.range(3), "u": spark.range(1)})
    broken = spark.range(5).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        store.replace("two", {"t": spark.range(9), "u": broken})
    assert numbers(store) == [0, 1, 2]


def test_unknown_table(store):
    assert not store.exists("t")
    with pytest.raises(LookupError):
        store.read("t")
    with pytest.raises(LookupError):
        store.read_all("t")


def test_opening_a_warehouse_again_keeps_it(spark, store):
    store.replace("one", {"t": spark.range(3)})
    assert numbers(Warehouse(spark, store.root + "/")) == [0, 1, 2]


def sellable(spark):
    """The odd cases without broken references, as a checked source would hold."""
    return samples.sources(
        spark,
        orders=[o for o in samples.ROWS["orders"] if o[5] != 77],
        orderdetails=[d for d in samples.ROWS["orderdetails"] if d[0] != 105 and d[1] != "S9"],
        payments=[p for p in samples.ROWS["payments"] if p[0] != 77],
    )


def test_build_twice_gives_the_same_tables(spark, store):
    counts = jobs.build(store, sellable(spark), "one", MOMENT)
    first = {n: sorted(map(str, df.collect())) for n, df in store.read_all(*counts).items()}
    assert jobs.build(store, sellable(spark), "two", MOMENT) == counts
    second = {n: sorted(map(str, df.collect())) for n, df in store.read_all(*counts).items()}
    assert first == second
    assert counts["fact_order_sales"] == 4 and counts["dim_date"] == 50
    report = jobs.revenue_report(store).collect()
    assert [(r.calendar_year, r.calendar_month, r.country, r.product_line) for r in report] == [
        (2020, 2, "France", "Cars"),
        (2020, 2, "France", "Ships"),
        (2020, 2, "Norway", "Cars"),
        (2020, 3, "Italy", "Ships"),
    ]
    top = jobs.top_customers_report(store, 2).collect()
    assert [(r.customer_name, float(r.gross_revenue)) for r in top] == [
        ("Alpha", 49.0),
        ("Gamma", 20.0),
    ]


def test_build_notices_collisions_and_missing_rows(spark, store):
    sources = sellable(spark)
    jobs.build(store, sources, "one", MOMENT)
    stored = store.read_all(*warehouse.TABLES)
    lost = {**stored, "fact_payments": stored["fact_payments"].limit(1)}
    with pytest.raises(RuntimeError, match="row counts differ.*fact_payments"):
        warehouse.verify(sources, lost)
    alike = {
        **stored,
        "dim_customer": stored["dim_customer"].withColumn("customer_key", F.lit(1)),
    }
    with pytest.raises(RuntimeError, match="collide"):
        warehouse.verify(sources, alike)
    strays = {**stored, "dim_product": stored["dim_product"].withColumn(
        "product_key", F.col("product_key") + 1)}
    with pytest.raises(RuntimeError, match="missing dimension rows.*product_key"):
        warehouse.verify(sources, strays)


def test_sync_then_build_follows_the_source(spark, store):
    sources = sellable(spark)
    first = jobs.sync_sources(store, sources, "one", MOMENT)
    jobs.build(store, first, "one-build", MOMENT)
    dearer = sources["products"].withColumn("buy_price", F.col("buy_price") + 1)
    changed = {
        **sources,
        "products": dearer.withColumn("buy_price", F.col("buy_price").cast("decimal(10,2)")),
        "orders": sources["orders"].where("order_number <> 104"),
        "orderdetails": sources["orderdetails"].where("order_number <> 104"),
    }
    second = jobs.sync_sources(store, changed, "two", MOMENT)
    counts = jobs.build(store, second, "two-build", MOMENT)
    assert counts["fact_order_sales"] == 3
    margins = store.read("fact_order_sales").select("sales_line_id", "margin_amount").collect()
    assert {r.sales_line_id: float(r.margin_amount) for r in margins} == {
        "100-S1": 12.0,
        "100-S2": -4.66,
        "101-S1": 1.34,
    }
    assert store.read("orders").where("is_deleted").count() == 1


def test_feed_jobs_use_the_synced_tables(spark, store):
    sources = {n: df for n, df in sellable(spark).items() if n in ("customers", "payments")}
    jobs.sync_sources(store, {"customers": sources["customers"]}, "one", MOMENT)
    folder = new_folder(spark, "files")
    sources["payments"].coalesce(1).write.parquet(f"{folder}/payments")
    feed = jobs.feed_payments(store, f"{folder}/payments", MOMENT)
    assert sorted(r.payment_id for r in feed.read().collect()) == ["1-C1", "2-C2"]
    moved = sources["customers"].where("customer_number = 1").withColumn("city", F.lit("Nice"))
    moved.coalesce(1).write.parquet(f"{folder}/changes")
    jobs.feed_changes(store, "customers", f"{folder}/changes")
    cities = {r.customer_number: r.city for r in store.read("customers").collect()}
    assert cities == {1: "Nice", 2: "Oslo", 3: "Rome", 4: "Bonn"}


def test_sources_from_files_and_as_views(spark):
    folder = new_folder(spark, "files")
    for name, df in samples.sources(spark).items():
        df.write.parquet(f"{folder}/{name}")
    loaded = load_sources(spark, folder)
    register_views(loaded, prefix="test_")
    joined = spark.sql(
        "SELECT count(*) AS n FROM test_orders JOIN test_customers USING (customer_number)"
    )
    assert joined.first().n == 5


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_partitions_follow_the_input():
    small = recommended_options(10**6, cores=8)
    large = recommended_options(100 * 10**12, cores=8_000)
    assert small[SHUFFLE_PARTITIONS] == "8" and small[SCAN_BYTES] == str(PARTITION_BYTES)
    # A hundred terabytes: at most some 100,000 scan tasks into 20,000 partitions.
    assert large[SHUFFLE_PARTITIONS] == "20000"
    assert 9 * 10**8 < int(large[SCAN_BYTES]) < 11 * 10**8


def test_running_session_is_fitted_to_the_input(spark, options):
    options(**{INITIAL_PARTITIONS: "8", SCAN_BYTES: str(PARTITION_BYTES)})
    fit_shuffles(spark, 5 * PARTITION_BYTES)
    assert spark.conf.get(INITIAL_PARTITIONS) == "8"
    fit_shuffles(spark, 500 * PARTITION_BYTES)
    assert spark.conf.get(INITIAL_PARTITIONS) == "500"
    assert int(spark.conf.get(SCAN_BYTES)) == PARTITION_BYTES
    fit_shuffles(spark, 10**14)
    assert spark.conf.get(INITIAL_PARTITIONS) == "20000"
    assert int(spark.conf.get(SCAN_BYTES)) > PARTITION_BYTES


def test_a_job_has_its_own_sizes_and_leaves_the_callers(spark, options):
    options(**{INITIAL_PARTITIONS: "8", "spark.sql.ansi.enabled": "true", TIME_ZONE: "Asia/Tokyo"})
    before = dict(spark.conf.getAll)
    job = scoped_session(spark, 500 * PARTITION_BYTES)
    assert job.conf.get(INITIAL_PARTITIONS) == "500" and job.conf.get(TIME_ZONE) == "UTC"
    assert job.conf.get("spark.sql.ansi.enabled") == "true"
    assert shared_folder(job) == shared_folder(spark)
    small = Ceilings(partition_bytes=1000, shuffle_partitions=7, scan_task_bytes=5000)
    job = scoped_session(spark, 10**6, small)
    assert job.conf.get(INITIAL_PARTITIONS) == "8"  # never below what the caller has
    assert scoped_session(spark, 10**6, Ceilings(partition_bytes=1000, shuffle_partitions=70)).conf.get(
        INITIAL_PARTITIONS
    ) == "70"
    assert dict(spark.conf.getAll) == before
    assert bucket_count(1) == 16 and bucket_count(10**14) == 20_000


def test_queries_leave_the_session_as_it_was(spark):
    before = dict(spark.conf.getAll)
    registered.queries()["src_sql_view"](spark, registered.SMOKE_DIR).collect()
    assert dict(spark.conf.getAll) == before
    assert "ledgerloom_orders" not in [t.name for t in spark.catalog.listTables()]


def test_fingerprint_follows_the_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    assert fingerprint(spark, f"{tmp_path}/a") == 0
    (tmp_path / "a" / "x").write_bytes(b"1")
    one = fingerprint(spark, f"{tmp_path}/a")
    (tmp_path / "a" / "x").write_bytes(b"12")
    assert len({0, one, fingerprint(spark, f"{tmp_path}/a")}) == 3


def test_stored_bytes_counts_files_and_folders(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "x.parquet").write_bytes(b"12345")
    (tmp_path / "y.parquet").write_bytes(b"123")
    assert stored_bytes(spark, f"{tmp_path}/a", f"{tmp_path}/y.parquet") == 8


def test_a_failed_check_leaves_the_old_tables(spark, store):
    sources = sellable(spark)
    jobs.build(store, sources, "one", MOMENT)
    before = {r["table_name"]: r["path"] for r in store.tables().collect()}
    doubled = {**sources, "customers": sources["customers"].union(sources["customers"])}
    with pytest.raises(RuntimeError):
        jobs.build(store, doubled, "two", MOMENT)
    assert {r["table_name"]: r["path"] for r in store.tables().collect()} == before


def test_report_is_whole(spark, store, tmp_path, capsys, monkeypatch):
    from ledgerloom import __main__ as command

    jobs.build(store, sellable(spark), "one", MOMENT)
    out = str(tmp_path / "revenue")
    arguments = ["ledgerloom", "--warehouse", store.root, "report", "--rows", "1", "--output", out]
    monkeypatch.setattr("sys.argv", arguments)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    command.main()
    assert "1 of 4 rows" in capsys.readouterr().out
    assert spark.read.parquet(out).count() == 4


def test_built_and_fed_payments_meet_once(spark, store):
    from ledgerloom.operators.facts import fact_payments
    from ledgerloom.streaming.payments import current_payments

    sources = sellable(spark)
    jobs.sync_sources(store, {"customers": sources["customers"]}, "one", MOMENT)
    built = sources["payments"].where("check_number = 'C1'")
    folder = new_folder(spark, "files")
    sources["payments"].coalesce(1).write.parquet(f"{folder}/payments")

    def ids():
        return sorted(r.payment_id for r in current_payments(store).collect())

    with pytest.raises(LookupError):
        current_payments(store)
    fact = fact_payments(built, sources["customers"], warehouse.load_time(MOMENT))
    store.replace("build", {"fact_payments": fact})
    assert ids() == ["1-C1"]
    jobs.feed_payments(store, f"{folder}/payments", MOMENT)
    assert ids() == ["1-C1", "2-C2"]


def test_build_from_the_command_line(spark, store, tmp_path, capsys, monkeypatch):
    from ledgerloom import __main__ as command

    for name, df in sellable(spark).items():
        df.write.parquet(f"{tmp_path}/sources/{name}")
    start = ["ledgerloom", "--warehouse", store.root, "build"]
    arguments = ["--source-folder", f"{tmp_path}/sources", "--keys", "murmur32"]
    monkeypatch.setattr("sys.argv", start + arguments)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    command.main()
    assert "fact_order_sales: 4 rows" in capsys.readouterr().out
    largest = store.read("dim_customer").agg(F.max("customer_key")).first()[0]
    assert largest <= 2**31


def test_integrity_reads_each_fact_once(spark, store):
    jobs.build(store, sellable(spark), "one", MOMENT)
    stored = store.read_all(*warehouse.TABLES)
    from ledgerloom.operators import audit

    checked = audit.fact_dim_integrity(stored)
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") + plan.count("Relation[") == 7
    empty = {**stored, "fact_payments": stored["fact_payments"].limit(0)}
    rows = {tuple(r) for r in audit.fact_dim_integrity(empty).collect()}
    assert ("fact_payments", "customer_key", "dim_customer", 0, 0, 0) in rows and len(rows) == 10


def test_tables_by_name(spark, store, capsys, monkeypatch):
    from ledgerloom import __main__ as command
    from ledgerloom.sinks.names import listed_tables, register_tables

    job = scoped_session(spark, 0)
    own = Warehouse(job, store.root)
    jobs.build(store, sellable(spark), "one", MOMENT)
    assert not job.catalog.tableExists("dim_customer")
    assert set(register_tables(own)) == set(warehouse.TABLES)
    assert job.catalog.tableExists("dim_customer") and not spark.catalog.tableExists("dim_customer")
    counts = {r.table_name: r.row_count for r in listed_tables(own).collect()}
    assert set(counts) == set(warehouse.TABLES) and counts["fact_order_sales"] == 4
    asked = "SELECT country, sum(quantity_ordered) AS n FROM fact_order_sales JOIN dim_customer USING (customer_key) GROUP BY 1"
    before = sorted(map(tuple, job.sql(asked).collect()))
    smaller = {n: df if n != "orderdetails" else df.limit(0) for n, df in sellable(spark).items()}
    jobs.build(store, smaller, "two", MOMENT)
    # names stay with the versions they were given for, until they are given again
    assert sorted(map(tuple, job.sql(asked).collect())) == before
    register_tables(own)
    assert job.sql(asked).count() == 0
    with pytest.raises(LookupError):
        register_tables(own, ["nowhere"])
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    monkeypatch.setattr("sys.argv", ["ledgerloom", "--warehouse", store.root, "sql", "SELECT count(*) AS days FROM dim_date"])
    command.main()
    assert "50" in capsys.readouterr().out
    monkeypatch.setattr("sys.argv", ["ledgerloom", "--warehouse", store.root, "expire", "--keep", "1"])
    command.main()
    assert "folders and" in capsys.readouterr().out and store.read("dim_customer").count() == 4
