"""The shape of the plans: what is read, what is shuffled, how hot keys are split."""

import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from ledgerloom.operators import audit, sizing, sync
from ledgerloom.operators.facts import fact_order_sales, fact_payments
from ledgerloom.plans import reports, warehouse
from ledgerloom.sources import retail

SF_DIR = registered.SMOKE_DIR
NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="module")
def sources(spark):
    return retail.load_sources(spark, SF_DIR)


def loaded():
    return warehouse.load_time(datetime(2024, 5, 1, tzinfo=timezone.utc))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df)


def scans(text):
    return re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", text)


def columns_read(text, some_column):
    for columns, _ in scans(text):
        names = {re.sub(r"#.*", "", c) for c in columns.split(",")}
        if some_column in names:
            return names
    raise AssertionError(f"no scan reads {some_column}")


def test_only_needed_columns_are_read(sources):
    fact = warehouse.build_table("fact_order_sales", sources, loaded())
    assert columns_read(plan(fact), "l_orderkey") == {
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_linenumber",
    }
    assert columns_read(plan(fact), "o_orderkey") == {
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
    }


def test_filters_reach_the_scan(sources):
    payments = plan(fact_payments(sources["payments"], sources["customers"], loaded()))
    assert any("EqualTo(event_type,purchase)" in pushed for _, pushed in scans(payments))


def test_report_reads_narrow_columns_of_the_stored_fact(spark):
    text = plan(registered.report_revenue_month_country_line(spark, SF_DIR))
    assert columns_read(text, "order_date_key") == {
        "order_date_key", "order_year", "part_run", "customer_key", "product_key",
        "quantity_ordered", "gross_sales_amount", "margin_amount",
    }


def test_no_python_in_any_plan(spark):
    for name in ("fact_order_sales", "dim_date", "report_top_customers", "sync_snapshot_diff"):
        text = plan(registered.queries()[name](spark, SF_DIR))
        assert "Python" not in text and "CartesianProduct" not in text
        assert "NestedLoop" not in text


def test_lines_are_shuffled_for_their_own_keys_only(sources, options):
    options(**NO_BROADCAST)
    text = plan(
        fact_order_sales(
            *[sources[i] for i in warehouse.TABLES["fact_order_sales"].inputs], loaded()
        )
    )
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", text)
    # Two shuffles hold lines: by order and by product. The rest is orders and smaller.
    assert sorted(keys) == sorted(
        ["order_number"] * 2 + ["product_code"] * 2 + ["customer_number"] * 2
        + ["sales_rep_employee_number"] * 2 + ["c_nationkey", "n_nationkey"]
    )


def test_small_derived_side_is_broadcast_and_a_large_one_is_not(spark):
    small = spark.range(10).select(F.col("id").cast("string").alias("k"))
    assert sizing.measured_bytes(small) == 10 * (16 + 8 + 1)
    assert sizing.measured_bytes(small.limit(0)) == 0
    other = spark.range(100).select(F.col("id").cast("string").alias("k"))

    def joined(limit):
        return plan(other.join(sizing.broadcast_if_small(small, limit), "k", "left"))

    assert "rightHint=(strategy=broadcast)" in _hints(other, small, 250)
    assert "rightHint" not in _hints(other, small, 249)
    assert "BroadcastHashJoin" in joined(250)


def _hints(left, right, limit):
    joined = left.join(sizing.broadcast_if_small(right, limit), "k", "left")
    return joined._jdf.queryExecution().optimizedPlan().toString()


def test_top_customers_sums_before_it_shuffles_and_takes_the_top(spark, options):
    options(**NO_BROADCAST)
    text = plan(registered.report_top_customers(spark, SF_DIR))
    assert "TakeOrderedAndProject" in text
    before_join = text[text.index("SortMergeJoin"):]
    assert "partial_sum(gross_sales_amount" in before_join


def test_few_changes_do_not_shuffle_the_table(spark):
    bronze = sync.initial_load(spark.range(1000).withColumn("v", F.lit(1)), loaded())
    changes = spark.range(5).withColumn("v", F.lit(2)).groupBy("id").agg(F.max("v").alias("v"))
    text = plan(sync.upsert(bronze, changes, ["id"], loaded(), ["v"]))
    kept = text[: text.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in kept and "LeftAnti" in kept
    assert "Exchange hashpartitioning" not in kept


@pytest.fixture
def small_partitions(options):
    """Shuffle joins at any size, and partitions above some kilobytes count as hot."""
    options(
        **NO_BROADCAST,
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8000",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


def test_hot_keys_are_split_in_the_sales_fact(spark, small_partitions):
    """A third of all lines belong to one order, a third to one product; one customer holds a
    third of the orders, one representative half of the customers."""
    n = 30_000
    ids = spark.range(0, n, 1, 8)
    key = F.col("id")
    orders = ids.select(
        key.cast("int").alias("order_number"),
        F.date_add(F.lit("2020-01-01").cast("date"), (key % 300).cast("int")).alias("order_date"),
        F.lit("2021-01-01").cast("date").alias("required_date"),
        F.lit(None).cast("date").alias("shipped_date"),
        F.lit("Shipped").alias("status"),
        F.when(key % 3 == 0, 7).otherwise(key % 5000).cast("int").alias("customer_number"),
    )
    lines = ids.select(
        F.when(key % 3 == 1, 11).otherwise(key).cast("int").alias("order_number"),
        F.when(key % 3 == 2, 13).otherwise(key % 4000).cast("int").alias("product_code"),
        F.lit(2).alias("quantity_ordered"),
        (key % 100).cast("decimal(10,2)").alias("price_each"),
        key.cast("int").alias("order_line_number"),
    )
    customers = spark.range(0, 5000, 1, 8).select(
        key.cast("int").alias("customer_number"),
        F.when(key % 2 == 0, 1).otherwise(key).cast("int").alias("sales_rep_employee_number"),
    )
    employees = spark.range(0, 5000, 1, 4).select(
        key.cast("int").alias("employee_number"), key.cast("string").alias("office_code")
    )
    products = spark.range(0, 4000, 1, 4).select(
        key.cast("int").alias("product_code"),
        F.lit(1).cast("decimal(10,2)").alias("buy_price"),
        F.lit(3).cast("decimal(10,2)").alias("msrp"),
    )
    fact = fact_order_sales(lines, orders, customers, products, employees, loaded())
    text = final_plan(fact)
    assert text.count("SortMergeJoin(skew=true)") >= 3
    totals = fact.agg(F.count(F.lit(1)), F.sum("gross_sales_amount")).first()
    assert totals[0] == n
    assert int(totals[1]) == 2 * sum(i % 100 for i in range(n))


def test_hot_customer_and_product_are_split_in_the_report(spark, small_partitions):
    n = 60_000
    key = F.col("id")
    fact = spark.range(0, n, 1, 8).select(
        (20200101 + key % 28).cast("int").alias("order_date_key"),
        F.when(key % 3 == 0, 7).otherwise(key % 4000).cast("bigint").alias("customer_key"),
        F.when(key % 3 == 1, 9).otherwise(key % 4000).cast("bigint").alias("product_key"),
        (key % 50).cast("int").alias("quantity_ordered"),
        F.xxhash64("id").cast("decimal(20,0)").cast("string").substr(-6, 6)
        .cast("decimal(12,2)").alias("gross_sales_amount"),
        F.lit(1).cast("decimal(12,2)").alias("margin_amount"),
    )
    days = spark.range(28).select(
        (20200101 + key).cast("int").alias("date_key"),
        F.lit(2020).alias("calendar_year"),
        F.lit(1).alias("calendar_month"),
    )
    customers = spark.range(4000).select(
        key.alias("customer_key"), F.lit("n").alias("customer_name"), F.lit("c").alias("country")
    )
    products = spark.range(4000).select(key.alias("product_key"), F.lit("l").alias("product_line"))
    report = reports.revenue_by_month_country_line(fact, days, customers, products)
    text = final_plan(report)
    assert text.count("SortMergeJoin(skew=true)") >= 2
    total = fact.agg(F.sum("gross_sales_amount")).first()[0]
    units = sum(i % 50 for i in range(n))
    assert [tuple(r)[-3:] for r in report.collect()] == [(units, total, n)]


def test_copies_collapse_before_the_shuffle(spark):
    copies = spark.range(0, 1000, 1, 4).select(
        F.when(F.col("id") < 900, 1).otherwise(2).alias("k"), F.col("id").alias("v")
    )
    for df in (
        sync.latest_per_key(copies, ["k"]),
        audit.key_uniqueness({"t": (copies, ("k",))}),
    ):
        text = plan(df)
        below_exchange = text[text.index("Exchange hashpartitioning(k"):]
        assert re.search(r"Aggregate\(key=\[k#|Aggregate\(keys=\[k#", below_exchange)


def test_integrity_counts_strays(spark):
    t = warehouse.build_all(retail.load_sources(spark, SF_DIR), loaded())
    t["dim_customer"] = t["dim_customer"].where("customer_number <> 5")
    checked = {(r.fact_table, r.fact_column): r for r in audit.fact_dim_integrity(t).collect()}
    sold = t["fact_order_sales"]
    lost = sold.join(t["dim_customer"], "customer_key", "left_anti").count()
    row = checked["fact_order_sales", "customer_key"]
    assert (row.stray_rows, row.stray_keys) == (lost, 1)
    nulls = sold.where("sales_rep_employee_key IS NULL").count()
    assert checked["fact_order_sales", "sales_rep_employee_key"].null_rows == nulls > 0
