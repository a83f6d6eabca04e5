import time
from datetime import date, datetime, timezone
from decimal import Decimal as D

import pytest
import samples
from pyspark.sql import functions as F

from ledgerloom.operators import sync
from ledgerloom.operators.facts import fact_payments
from ledgerloom.plans.warehouse import load_time
from ledgerloom.session import new_folder
from ledgerloom.sinks.warehouse import Warehouse
from ledgerloom.streaming.changes import run_upserts
from ledgerloom.streaming.files import as_glob, table_stream
from ledgerloom.streaming.payments import PaymentsFeed

PAYMENTS = "customer_number int, check_number string, payment_date date, amount decimal(10,2)"


def loaded():
    return load_time(datetime(2024, 5, 1, tzinfo=timezone.utc))


class Source:
    """A parquet folder that grows file by file."""

    def __init__(self, spark, schema):
        self.spark, self.schema = spark, schema
        self.path = new_folder(spark, "source")

    def add(self, *rows):
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.mode(
            "append"
        ).parquet(self.path)

    def stream(self, files_per_batch=1):
        return table_stream(self.spark, self.path, files_per_batch)


@pytest.fixture
def source(spark):
    return Source(spark, PAYMENTS)


def payment(customer, check, day=1, amount="1.00"):
    return (customer, check, date(2020, 1, day), D(amount))


def payments_feed(spark, customers):
    folder = new_folder(spark, "feed")
    return PaymentsFeed(Warehouse(spark, folder), f"{folder}/feed", customers, loaded())


def ids(df):
    return sorted(r.payment_id for r in df.collect())


def test_payments_equal_the_batch_fact(spark, source):
    customers = samples.sources(spark)["customers"]
    source.add(payment(1, "A", 30), payment(2, "B"))
    source.add(payment(2, "C", 2), payment(1, "D", 3))
    source.add(payment(3, "E", 1))
    feed = payments_feed(spark, lambda: customers)
    feed.run(source.stream())
    batch = fact_payments(spark.read.parquet(source.path), customers, loaded())
    assert feed.read().columns == batch.columns
    assert sorted(feed.read().collect()) == sorted(batch.collect())


def test_copies_in_one_batch_and_over_batches_count_once(spark, source):
    customers = samples.sources(spark)["customers"]
    feed = payments_feed(spark, lambda: customers)
    source.add(payment(1, "A"), payment(1, "A"), payment(2, "A"))
    source.add(payment(1, "A"), payment(1, "B", 31))
    feed.run(source.stream())
    assert ids(feed.read()) == ["1-A", "1-B", "2-A"]
    # Delivered again much later, after the stream was stopped and started.
    source.add(payment(1, "A"), payment(1, "C"))
    feed.run(source.stream())
    feed.run(source.stream())
    assert ids(feed.read()) == ["1-A", "1-B", "1-C", "2-A"]


def test_payment_of_a_late_customer_waits(spark, source):
    customers = samples.sources(spark)["customers"]
    known = {"now": customers.where("customer_number <> 2")}
    feed = payments_feed(spark, lambda: known["now"])
    source.add(payment(1, "A"), payment(2, "B", amount="7.50"))
    source.add(payment(1, "C"))
    feed.run(source.stream())
    assert ids(feed.read()) == ["1-A", "1-C"]
    assert [tuple(r) for r in feed.waiting().collect()] == [payment(2, "B", amount="7.50")]
    known["now"] = customers
    source.add(payment(3, "D"))
    feed.run(source.stream())
    assert ids(feed.read()) == ["1-A", "1-C", "2-B", "3-D"]
    assert feed.waiting().count() == 0


def test_run_that_dies_before_publishing_is_made_up(spark, source, monkeypatch):
    customers = samples.sources(spark)["customers"]
    feed = payments_feed(spark, lambda: customers)
    source.add(payment(1, "A"))
    feed.run(source.stream())
    source.add(payment(1, "A"), payment(2, "B"))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(feed.landing, "publish", lost)
        with pytest.raises(RuntimeError, match="lost"):
            feed.run(source.stream())
    assert ids(feed.read()) == ["1-A"]
    # The batch is landed and the stream has moved on, yet the next run picks it up.
    feed.run(source.stream())
    assert ids(feed.read()) == ["1-A", "2-B"]
    feed.run(source.stream())
    assert ids(feed.read()) == ["1-A", "2-B"]


def test_new_landing_folder_starts_from_its_own_batches(spark, source):
    customers = samples.sources(spark)["customers"]
    feed = payments_feed(spark, lambda: customers)
    source.add(payment(1, "A"))
    source.add(payment(1, "B"))
    feed.run(source.stream())
    # The checkpoint is lost: everything is delivered again, to another folder.
    again = PaymentsFeed(feed.store, f"{feed.landing.folder}-2", lambda: customers, loaded())
    source.add(payment(2, "C"))
    again.run(source.stream(files_per_batch=10))
    assert ids(again.read()) == ["1-A", "1-B", "2-C"]


def test_landed_batch_written_again_counts_once(spark, source):
    customers = samples.sources(spark)["customers"]
    feed = payments_feed(spark, lambda: customers)
    source.add(payment(1, "A"), payment(2, "B"))
    feed.landing.land(source.stream())
    first = spark.read.parquet(f"{feed.landing.folder}/landed/batch_id=0")
    rows = [tuple(r) for r in first.collect()]
    spark.createDataFrame(rows, PAYMENTS).write.mode("overwrite").parquet(
        f"{feed.landing.folder}/landed/batch_id=0"
    )
    feed.run(source.stream())
    assert ids(feed.read()) == ["1-A", "2-B"]


def test_empty_stream(spark, source):
    customers = samples.sources(spark)["customers"]
    feed = payments_feed(spark, lambda: customers)
    source.add(payment(77, "A"))
    feed.run(source.stream())
    assert feed.read().count() == 0 and feed.waiting().count() == 1


def test_stream_without_files(spark, source):
    source.spark.createDataFrame([], PAYMENTS).write.parquet(source.path)
    customers = samples.sources(spark)["customers"]
    feed = payments_feed(spark, lambda: customers)
    feed.run(source.stream())
    feed.run(source.stream())
    assert ids(feed.read()) == []


def test_changed_rows_are_upserted_in_order(spark):
    schema = "id bigint, name string, seq bigint"
    source = Source(spark, schema)
    folder = new_folder(spark, "bronze")
    store = Warehouse(spark, folder)
    start = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], schema)
    sync.sync_tables(store, {"t": start}, {"t": ("id",)}, loaded(), "start")

    def run():
        run_upserts(source.stream(), store, "t", ("id",), f"{folder}/feed", ("seq",))
        return {r.id: r.name for r in store.read("t").collect()}

    source.add((1, "x", 2), (1, "y", 1), (3, "c", 1))
    source.add((3, None, 2))
    assert run() == {1: "x", 2: "b", 3: None}
    assert store.versions().count() == 2
    untouched = store.read("t").where(F.col("synced_at") == loaded())
    assert [r.id for r in untouched.collect()] == [2]
    # A change that comes late and is older than what the table holds does not count.
    source.add((2, "z", 3), (1, "late", 1))
    assert run() == {1: "x", 2: "z", 3: None}
    assert run() == {1: "x", 2: "z", 3: None}
    assert store.versions().count() == 3


CHANGES = "id bigint, v bigint"


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_the_last_delivery_counts_not_the_largest_row(spark, files_per_batch):
    source = Source(spark, CHANGES)
    folder = new_folder(spark, "bronze")
    store = Warehouse(spark, folder)
    start = spark.createDataFrame([(1, 10), (2, 20)], CHANGES)
    sync.sync_tables(store, {"t": start}, {"t": ("id",)}, loaded(), "start")
    source.add((1, 90))
    time.sleep(1.1)  # file times have whole seconds on some systems
    source.add((1, 50), (2, 5))
    path = f"{source.path}/"  # a slash at the end does no harm
    changes = table_stream(spark, path, files_per_batch, with_delivery=True)
    run_upserts(changes, store, "t", ("id",), f"{folder}/feed")
    got = store.read("t")
    assert {r.id: r.v for r in got.collect()} == {1: 50, 2: 5}
    assert not {"delivered_at", "changes_tied"} & set(got.columns)


def test_changes_that_tie_with_other_values_raise(spark):
    source = Source(spark, CHANGES)
    folder = new_folder(spark, "bronze")
    store = Warehouse(spark, folder)
    start = spark.createDataFrame([(1, 10)], CHANGES)
    sync.sync_tables(store, {"t": start}, {"t": ("id",)}, loaded(), "start")
    rows = spark.createDataFrame([(1, 7), (1, 8), (1, 8)], CHANGES)
    rows.coalesce(1).write.mode("append").parquet(source.path)
    changes = table_stream(spark, source.path, with_delivery=True)
    with pytest.raises(ValueError, match="one key and order differ"):
        run_upserts(changes, store, "t", ("id",), f"{folder}/feed")
    assert [r.v for r in store.read("t").collect()] == [10]


def test_paths_with_glob_signs(spark):
    path = f"{new_folder(spark, 'odd')}/a[1]{{x}}-*"
    assert as_glob("/data/new/") == "/data/ne[w]"
    escaped = as_glob(path)
    assert escaped.count("\\") == 5 and escaped.endswith("[x]\\}-\\*")
