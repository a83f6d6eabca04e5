"""What a run reads and writes of tables in partitions."""

import random
from datetime import date, datetime, timezone
from decimal import Decimal as D
from pathlib import Path

import pytest
import samples
from pyspark.sql import functions as F

import __spark_entry__ as registered
from ledgerloom.functions import KeyScheme
from ledgerloom.operators import sync
from ledgerloom.operators.facts import ORDER_YEAR
from ledgerloom.plans import jobs, refresh, reports, warehouse
from ledgerloom.session import new_folder
from ledgerloom.sinks import expiry
from ledgerloom.sinks.warehouse import ALL, BUCKET, Layout, Warehouse
from ledgerloom.streaming.changes import run_upserts
from ledgerloom.streaming.files import table_stream
from ledgerloom.streaming.payments import TABLE, PaymentsFeed

MOMENT = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
KEYED = "id bigint, v bigint"


@pytest.fixture
def store(spark):
    return Warehouse(spark, new_folder(spark, "partitions"))


def loaded():
    return warehouse.load_time(MOMENT)


def parts_of(store, name):
    return store.current([name])[name].parts


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- the store -----------------------------------------------------------------------------


def numbers(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_parts_replace_and_add_up(spark, store):
    layout = Layout("half", F.col("id") % 2)
    store.replace("one", {"t": spark.range(6)}, {"t": layout})
    odd = store.stage_parts("two", "t", spark.range(11, 14, 2), layout, ["1"])
    store.publish("two", [odd])
    assert numbers(store.read("t")) == [0, 2, 4, 11, 13]
    assert numbers(store.read("t", at=store.versions().where("run_id = 'one'").first()["path"])) == list(range(6))
    added = store.stage_appended("three", "t", store.current(["t"])["t"], spark.range(20, 21), layout)
    store.publish("three", [added])
    assert numbers(store.read("t", values=["0"])) == [0, 2, 4, 20]
    assert store.tables().first()["row_count"] == 6
    # a partition that is left without rows
    store.publish("four", [store.stage_parts("four", "t", spark.range(0), layout, ["1"])])
    assert numbers(store.read("t")) == [0, 2, 4, 20] and set(parts_of(store, "t")) == {"0"}
    # what a run publishes again takes its own former place
    store.publish("four", [store.stage_parts("four", "t", spark.range(0), layout, ["0"])])
    assert numbers(store.read("t")) == [11, 13]
    assert store.read("t").columns == ["id", "half"]
    store.replace("five", {"t": spark.range(0)}, {"t": layout})
    assert numbers(store.read("t")) == [] and store.read("t").columns == ["id", "half"]
    store.replace("six", {"t": spark.range(1)})
    assert numbers(store.read("t")) == [0] and store.current(["t"])["t"].partition_column is None


def test_touched_since_a_version(spark, store):
    layout = Layout("part", F.col("id") % 4)
    store.replace("one", {"t": spark.range(8)}, {"t": layout})
    start = store.current(["t"])["t"]
    assert start.touched_since(start) == []
    store.publish("two", [store.stage_parts("two", "t", spark.range(1, 2), layout, ["1", "3"])])
    assert store.current(["t"])["t"].touched_since(start) == ["1", "3"]
    assert store.current(["t"], at={"t": start.path})["t"] == start
    store.replace("three", {"t": spark.range(8)})
    assert store.current(["t"])["t"].touched_since(start) == [ALL]


def test_lists_of_older_versions_stay_readable(spark, store):
    old = "run_id string, published_at timestamp, table_name string, path string, row_count bigint"
    spark.range(3).write.parquet(f"{store.root}/data/old/t")
    spark.createDataFrame([("old", MOMENT, "t", f"{store.root}/data/old/t", 3)], old).write.mode(
        "append"
    ).parquet(f"{store.root}/published")
    assert numbers(store.read("t")) == [0, 1, 2]
    assert store.tables().first()["row_count"] == 3
    sync.sync_tables(store, {"u": spark.range(4)}, {"u": ["id"]}, loaded(), "new")
    assert numbers(store.read("t")) == [0, 1, 2] and numbers(store.read("u")) == [0, 1, 2, 3]


# --- bronze tables: only buckets with a change are written ------------------------------------


def test_a_sync_writes_only_buckets_with_a_change(spark, store):
    rows = spark.range(200).select("id", (F.col("id") * 10).alias("v"))
    sync.sync_tables(store, {"t": rows}, {"t": ["id"]}, loaded(), "one", buckets=8)
    before = parts_of(store, "t")
    assert len(before) == 8 and all(len(p) == 1 for p in before.values())
    files = set(store.read("t").inputFiles())
    changed = rows.where("id <> 7").withColumn("v", F.when(F.col("id") == 5, -1).otherwise(F.col("v")))
    written = sync.sync_tables(store, {"t": changed}, {"t": ["id"]}, loaded(), "two")
    after = parts_of(store, "t")
    touched = {r[0] for r in store.read("t").where("id in (5, 7)").select(BUCKET).distinct().collect()}
    assert {v for v in before if before[v] != after[v]} == {str(b) for b in touched}
    assert len(set(store.read("t").inputFiles()) - files) == len(touched) <= 2
    assert written["t"] == store.read("t").where(F.col(BUCKET).isin(*touched)).count()
    got = {r.id: (r.v, r.is_deleted) for r in store.read("t").collect()}
    assert got == {i: (-1 if i == 5 else i * 10, i == 7) for i in range(200)}
    # nothing changes: nothing is written
    sync.sync_tables(store, {"t": changed}, {"t": ["id"]}, loaded(), "three")
    assert parts_of(store, "t") == after


def test_a_feed_writes_only_buckets_with_a_change(spark, store):
    rows = spark.range(200).select("id", (F.col("id") * 10).alias("v"))
    sync.sync_tables(store, {"t": rows}, {"t": ["id"]}, loaded(), "one", buckets=8)
    before = parts_of(store, "t")
    source = new_folder(spark, "source")
    spark.createDataFrame([(5, -1), (900, 1)], KEYED).coalesce(1).write.parquet(source)
    run_upserts(table_stream(spark, source), store, "t", ("id",), f"{store.root}/feed")
    after = parts_of(store, "t")
    touched = {r[0] for r in store.read("t").where("id in (5, 900)").select(BUCKET).distinct().collect()}
    assert {v for v in before if before[v] != after[v]} == {str(b) for b in touched}
    got = {r.id: r.v for r in store.read("t").collect()}
    assert got == {i: i * 10 for i in range(200)} | {5: -1, 900: 1}


def test_table_that_was_not_cut_yet_is_cut_by_the_next_sync(spark, store):
    rows = spark.range(20).select("id", (F.col("id") * 10).alias("v"))
    store.replace("old", {"t": sync.initial_load(rows, loaded())})
    sync.sync_tables(store, {"t": rows.where("id > 3")}, {"t": ["id"]}, loaded(), "new", buckets=4)
    assert len(parts_of(store, "t")) == 4 and store.read("t").where("not is_deleted").count() == 16


def test_changes_of_a_snapshot(spark):
    schema = "id bigint, v bigint"
    one, two = (warehouse.load_time(datetime(2024, 1, d, tzinfo=timezone.utc)) for d in (1, 2))
    bronze = sync.initial_load(spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 4)], schema), one)
    bronze = sync.merge_snapshot(bronze, spark.createDataFrame([(1, 1), (2, 2), (3, None)], schema), ["id"], two)
    snapshot = spark.createDataFrame([(1, 1), (3, 3), (4, 4), (5, None)], schema)
    changes = sync.changed_rows(bronze, snapshot, ["id"])
    assert {(r.id, r.v, r.is_deleted, r.change_type) for r in changes.collect()} == {
        (2, 2, True, "delete"), (3, 3, False, "update"), (4, 4, False, "insert"), (5, None, False, "insert"),
    }
    merged = sync.merge_changes(bronze, changes.drop("change_type"), ["id"], two)
    whole = sync.merge_snapshot(bronze, snapshot, ["id"], two)
    assert sorted(merged.collect()) == sorted(whole.select(*merged.columns).collect())


# --- payments: the table is its own index -----------------------------------------------------

PAYMENTS = "customer_number int, check_number string, payment_date date, amount decimal(10,2)"


def deliver(spark, path, *checks):
    rows = [(1 + c % 4, f"C{c}", date(2020, 1, 1 + c % 28), D("1.00")) for c in checks]
    spark.createDataFrame(rows, PAYMENTS).coalesce(1).write.mode("append").parquet(path)


def test_a_small_delivery_reads_its_buckets_only(spark, store):
    customers = samples.sources(spark)["customers"]
    source = new_folder(spark, "source")
    feed = PaymentsFeed(store, f"{store.root}/feed", lambda: customers, loaded(), buckets=16)
    deliver(spark, source, *range(300))
    feed.run(table_stream(spark, source))
    table = store.current([TABLE])[TABLE]
    assert len(table.parts) == 16
    deliver(spark, source, 7, 1000)
    fresh = spark.read.parquet(source).where("check_number in ('C7', 'C1000')").limit(2)
    held = feed.held_keys(fresh, table)
    buckets = {r[0] for r in fresh.select(Layout.by_bucket(("customer_number", "check_number"), 16).value).collect()}
    opened = {f.split(f"{BUCKET}=")[1].split("/")[0] for f in held.inputFiles()}
    assert opened == {str(b) for b in buckets} and len(opened) <= 2
    assert "ReadSchema: struct<customer_number:int,check_number:string>" in plan(held)
    feed.run(table_stream(spark, source))
    assert feed.read().count() == 301
    after = parts_of(store, TABLE)
    assert sum(len(p) for p in after.values()) <= 17


def test_parts_of_a_bucket_are_put_together_again(spark, store):
    customers = samples.sources(spark)["customers"]
    source = new_folder(spark, "source")
    feed = PaymentsFeed(store, f"{store.root}/feed", lambda: customers, loaded(), buckets=1, most_parts=3)
    checks, parts = [], []
    for run in range(5):
        checks += [run, 100 + run]
        deliver(spark, source, run, 100 + run, *checks[:4])
        feed.run(table_stream(spark, source))
        parts.append(len(parts_of(store, TABLE)["0"]))
    got = sorted(r.check_number for r in feed.read().collect())
    assert got == sorted(f"C{c}" for c in checks)
    assert parts == [1, 2, 3, 1, 2]


# --- the sales fact: only affected lines are joined -------------------------------------------


def random_sources(spark, rng, lines=120):
    """Sound sources: every reference exists and every key is held once."""
    S = samples.ROWS
    offices = S["offices"]
    employees = [(10 + i, "L", "F", "x", "e", str(1 + i % 2), None, "Rep") for i in range(4)]
    customers = [
        (c, f"N{c}", "l", "f", "p", "a", None, "x", None, None, "France", rng.choice([None, 10, 11, 12, 13]), None)
        for c in range(1, 9)
    ]
    products = [(f"S{p}", "n", "Cars", "s", "v", "d", 1, D("10.00") + rng.randint(0, 3), D("20.00")) for p in range(9)]
    orders = [
        (o, date(2018 + o % 5, 1, 1 + o % 28), date(2024, 1, 1), None, rng.choice(["Shipped", "Cancelled", "On Hold"]),
         rng.randint(1, 8))
        for o in range(1, 41)
    ]
    pairs = sorted({(rng.randint(1, 40), rng.randint(0, 8)) for _ in range(lines)})
    details = [(o, f"S{p}", rng.randint(1, 5), D("15.00"), 1) for o, p in pairs]
    return {
        "offices": offices, "employees": employees, "customers": customers, "productlines": S["productlines"],
        "products": products, "orders": orders, "orderdetails": details,
        "payments": [(1, "A", date(2020, 1, 1), D("1.00"))],
    }


def changed_at(rng, rows, tables):
    """A few rows of some tables changed, one deleted, one back."""
    changed = {n: list(r) for n, r in rows.items()}
    for name in tables:
        own = changed[name]
        at = rng.randrange(len(own))
        row = list(own[at])
        if name == "orders":
            row[4], row[1] = rng.choice(["Shipped", "Cancelled"]), date(2018 + rng.randrange(5), 2, 2)
        elif name == "orderdetails":
            if rng.random() < 0.5:
                own.pop(rng.randrange(len(own)))
                continue
            row[2] += 1
        elif name == "customers":
            row[11] = rng.choice([None, 10, 13])
        elif name == "products":
            row[7] += 1
        elif name == "employees":
            row[5] = "2" if row[5] == "1" else "1"
        own[at] = tuple(row)
    return changed


def test_refresh_equals_a_full_build(spark, store):
    rng = random.Random(2)
    rows = random_sources(spark, rng)

    def synced(run):
        sources = {n: samples.sources(spark, **{n: r})[n] for n, r in rows.items()}
        jobs.sync_sources(store, sources, run, MOMENT, buckets=4)

    synced("start")
    jobs.refresh(store, "start-build", MOMENT)  # nothing to start from: a full build
    steps = [["products", "employees"], ["customers", "orders", "orderdetails"], []]
    for number, tables in enumerate(steps):
        rows = changed_at(rng, rows, tables)
        synced(f"sync-{number}")
        before = parts_of(store, refresh.FACT)
        jobs.refresh(store, f"build-{number}", MOMENT, verify=number == 0)
        after = parts_of(store, refresh.FACT)
        sources = jobs.bronze_sources(store, store.paths(list(rows)))
        whole = warehouse.build_table(refresh.FACT, sources, loaded())
        got = store.read(refresh.FACT).drop(ORDER_YEAR)
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
        if not tables:
            assert before == after
    assert refresh.refreshable(store) and not refresh.refreshable(store, KeyScheme.MURMUR32)


def test_untouched_lines_are_copied_and_other_years_stay(spark, store):
    rng = random.Random(5)
    rows = random_sources(spark, rng)
    sources = {n: samples.sources(spark, **{n: r})[n] for n, r in rows.items()}
    jobs.sync_sources(store, sources, "one", MOMENT, buckets=4)
    jobs.refresh(store, "one-build", MOMENT)
    before = parts_of(store, refresh.FACT)
    line = next(r for r in store.read(refresh.FACT).collect())
    changed = [(*o[:2], date(2030, 1, 1), *o[3:]) if o[0] == line.order_number else o for o in rows["orders"]]
    sources["orders"] = samples.sources(spark, orders=changed)["orders"]
    jobs.sync_sources(store, sources, "two", MOMENT, buckets=4)
    later = datetime(2024, 6, 1, 12, tzinfo=timezone.utc)
    jobs.refresh(store, "two-build", later)
    after = parts_of(store, refresh.FACT)
    assert {v for v in before if before[v] != after[v]} == {str(line.order_year)}
    fact = store.read(refresh.FACT)
    anew = fact.where(F.col("etl_loaded_at") == warehouse.load_time(later))
    assert {r.order_number for r in anew.collect()} == {line.order_number}
    # the copy meets nothing but the keys of what changed
    keys = fact.select("order_number").limit(1)
    products = fact.select("product_key").limit(1)
    copied = plan(refresh.untouched(store.read(refresh.FACT, values=[str(line.order_year)]), keys, products))
    assert copied.count("LeftAnti") == copied.count("Join") == 2
    assert copied.count("FileScan") <= 3 and "bronze" not in copied


def test_a_build_refuses_to_follow_a_newer_one(spark, store, monkeypatch):
    rows = random_sources(spark, random.Random(1))
    sources = {n: samples.sources(spark, **{n: r})[n] for n, r in rows.items()}
    stage = store.stage

    def stage_slowly(run_id, tables, layouts=None):
        written = stage(run_id, tables, layouts)
        if run_id == "slow":
            jobs.build(Warehouse(spark, store.root), sources, "fast", MOMENT, verify=False)
        return written

    monkeypatch.setattr(store, "stage", stage_slowly)
    with pytest.raises(RuntimeError, match="another run published"):
        jobs.build(store, sources, "slow", MOMENT, verify=False)


# --- expiry -------------------------------------------------------------------------------------


def exists(path):
    return Path(path.removeprefix("file:")).exists()


def test_expiry_keeps_what_current_tables_need(spark, store):
    rng = random.Random(4)
    rows = random_sources(spark, rng, lines=30)
    source = new_folder(spark, "payments")
    known = {"now": samples.sources(spark)["customers"].where("customer_number <> 2")}

    def feed():
        return PaymentsFeed(store, f"{store.root}/feed", lambda: known["now"], loaded(), buckets=2)

    for run in range(3):
        rows = changed_at(rng, rows, ["products", "orders"]) if run else rows
        used = {n: samples.sources(spark, **{n: r})[n] for n, r in rows.items()}
        jobs.sync_sources(store, used, f"sync-{run}", MOMENT, buckets=2)
        if run < 2:
            jobs.refresh(store, f"build-{run}", MOMENT, verify=False)
        deliver(spark, source, 3 * run, 3 * run + 1, 3 * run + 2)
        feed().run(table_stream(spark, source))
    names = [r["table_name"] for r in store.tables().collect()]
    before = {n: sorted(map(str, store.read(n).collect())) for n in names}
    landed = next(r["path"] for r in store.versions().where("run_id = 'sync-0-landing'").collect())
    base = store.made_from(refresh.FACT)["products"]
    assert base != store.paths(["products"])["products"] and exists(landed)
    gone = expiry.expire(store, keep=1)
    assert gone.entries > 0 and gone.folders > 0 and not exists(landed)
    assert len(store.list_files()) == 1
    assert {n: sorted(map(str, store.read(n).collect())) for n in names} == before
    # a refresh still finds the versions it has to compare with
    jobs.refresh(store, "build-3", MOMENT, verify=False)
    bronze = jobs.bronze_sources(store, store.paths(list(rows)))
    whole = warehouse.build_table(refresh.FACT, bronze, loaded())
    got = store.read(refresh.FACT).drop(ORDER_YEAR)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    # the feed goes on where it was, and payments that waited are taken in
    waited = feed().waiting().count()
    assert waited > 0 and expiry.expire_landed(feed().landing) > 0
    known["now"] = samples.sources(spark)["customers"]
    deliver(spark, source, 50)
    feed().run(table_stream(spark, source))
    assert feed().read().count() == 10 and feed().waiting().count() == 0
    # running it again changes nothing that can be read
    now = {n: store.read(n).count() for n in names}
    expiry.expire(store, keep=1)
    assert expiry.expire(store, keep=1).folders == 0
    assert {n: store.read(n).count() for n in names} == now
    with pytest.raises(ValueError):
        expiry.expire(store, keep=0)


def test_expiry_remembers_partitions_that_were_emptied(spark, store):
    layout = Layout("half", F.col("id") % 2)
    store.replace("one", {"t": spark.range(6)}, {"t": layout})
    store.publish("two", [store.stage_parts("two", "t", spark.range(0), layout, ["1"])])
    store.publish("three", [store.stage_parts("three", "t", spark.range(0, 2, 2), layout, ["0"])])
    expiry.expire(store, keep=1)
    assert numbers(store.read("t")) == [0]


# --- facts by year ------------------------------------------------------------------------------


def test_a_choice_of_days_prunes_years_at_run_time(spark):
    report = registered.report_revenue_one_year(spark, registered.SMOKE_DIR)
    text = plan(report)
    assert "dynamicpruning" in text and "order_year" in text[text.index("PartitionFilters") :]
    report.collect()
    metrics = _scan_metrics(report, "order_date_key")
    tables = registered._stored(spark, registered.SMOKE_DIR).read_all(*registered.STAR)
    whole = reports.revenue_by_month_country_line(*[tables[n] for n in registered.STAR])
    whole.collect()
    assert metrics < _scan_metrics(whole, "order_date_key")
    kept = [r for r in whole.collect() if r.calendar_year == 1995]
    assert kept and report.collect() == kept


def _scan_metrics(df, column):
    """Files that the scan with this column has read."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("Scan") and column in node.output().mkString(","):
            found.append(node.metrics().apply("numFiles").value())
        inner = [node.executedPlan()] if name == "AdaptiveSparkPlan" else []
        inner += [node.plan()] if "QueryStage" in name else []
        children = node.children()
        for child in [*inner, *(children.apply(i) for i in range(children.size()))]:
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return max(found)


def test_whole_replacement_is_named(store, spark):
    written = store.stage_parts("one", "t", spark.range(1), Layout("x", F.lit(1)))
    assert written.replaced == (ALL,) and dict(written.parts) == {"1": 1}
