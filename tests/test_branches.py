"""Joins that count what they drop: same rows, counts by definition, audits without the lines."""

from datetime import datetime, timezone

import pytest
import samples
from pyspark.sql import functions as F

import __spark_entry__ as registered
from ledgerloom.operators import audit
from ledgerloom.operators.branches import Branches, expected
from ledgerloom.plans import jobs, warehouse
from ledgerloom.sinks.warehouse import Warehouse
from ledgerloom.sources import retail

MOMENT = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
FACTS = ("fact_order_sales", "fact_payments")


def loaded():
    return warehouse.load_time(MOMENT)


@pytest.fixture
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


@pytest.mark.parametrize("name", FACTS)
def test_counted_joins_give_the_rows_of_inner_joins(spark, name, tmp_path):
    sources = samples.sources(spark)
    branches = Branches()
    counted = warehouse.build_table(name, sources, loaded(), branches=branches)
    plain = warehouse.build_table(name, sources, loaded())
    assert counted.schema == plain.schema
    counted.write.parquet(str(tmp_path / name))
    rows = spark.read.parquet(str(tmp_path / name))
    assert sorted(map(str, rows.collect())) == sorted(map(str, plain.collect()))
    assert branches.agreed(rows.count()) == branches.counts()


def test_counts_of_the_lines_by_hand(spark, store):
    written = {w.name: w for w in warehouse.stage_all(store, "one", samples.sources(spark), loaded())}
    # cancelled, no status, unknown buyer; then a product nobody knows
    assert written["fact_order_sales"].metrics == {"entered": 8, "no_order": 3, "no_product": 1}
    assert written["fact_payments"].metrics == {"entered": 3, "no_customer": 1}
    assert written["dim_product"].metrics is None


def test_repeated_keys_leave_no_counts_and_fail_the_check(spark, store):
    twice = samples.ROWS["products"] + samples.ROWS["products"][:1]
    sources = samples.sources(spark, products=twice)
    written = {w.name: w for w in warehouse.stage_all(store, "one", sources, loaded())}
    assert written["fact_order_sales"].metrics == {}
    assert written["fact_payments"].metrics != {}
    with pytest.raises(RuntimeError, match="row counts differ.*fact_order_sales"):
        jobs.build(store, sources, "two", MOMENT)


def test_empty_sources(spark, store):
    sources = samples.empty_sources(spark)
    jobs.build(store, sources, "one", MOMENT)
    for name in FACTS:
        assert expected(store.metrics(name)) in (0, None)


def test_counts_are_kept_with_the_version_and_go_with_a_refresh(spark, store):
    sources = samples.sources(spark)
    jobs.sync_sources(store, sources, "s1", MOMENT)
    jobs.build_from_bronze(store, "b1", MOMENT, verify=False)
    counted = warehouse.counted_rows({n: store.metrics(n) for n in warehouse.TABLES})
    assert counted == {"fact_order_sales": 4, "fact_payments": 2}
    fewer = {**sources, "orderdetails": sources["orderdetails"].where("order_number != 100")}
    jobs.sync_sources(store, fewer, "s2", MOMENT)
    jobs.refresh(store, "b2", MOMENT, verify=False)
    assert store.metrics("fact_order_sales") == {}
    tables = store.read_all(*warehouse.TABLES)
    audited = audit.target_counts(fewer, tables, warehouse.counted_rows({n: store.metrics(n) for n in tables}))
    rows = {r["table_name"]: (r["expected_rows"], r["stored_rows"]) for r in audited.collect()}
    assert rows["fact_order_sales"] == (2, 2)


def test_lost_rows_are_found_without_the_lines(spark, store):
    sources = samples.sources(spark)
    jobs.build(store, sources, "one", MOMENT, verify=False)
    counted = warehouse.counted_rows({n: store.metrics(n) for n in warehouse.TABLES})
    stored = store.read_all(*warehouse.TABLES)
    short = {**stored, "fact_order_sales": stored["fact_order_sales"].limit(3)}
    wrong = audit.target_counts(sources, short, counted).where(~F.col("matches")).collect()
    assert [(r["table_name"], r["expected_rows"], r["stored_rows"]) for r in wrong] == [("fact_order_sales", 4, 3)]


def test_audit_does_not_read_the_lines_or_join_the_payments(spark, tmp_path):
    sources = retail.load_sources(spark, registered.SMOKE_DIR)
    store = Warehouse(spark, str(tmp_path / "wh"))
    store.publish("one", warehouse.stage_all(store, "one", sources, loaded()))
    counted = warehouse.counted_rows({n: store.metrics(n) for n in warehouse.TABLES})
    assert set(counted) == set(FACTS)
    stored = store.read_all(*warehouse.TABLES)
    fast, slow = (audit.target_counts(sources, stored, c) for c in (counted, None))
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (fast, slow)]
    assert "l_orderkey" not in plans[0] and "LeftSemi" not in plans[0]
    assert "l_orderkey" in plans[1] and "LeftSemi" in plans[1]
    assert sorted(map(str, fast.collect())) == sorted(map(str, slow.collect()))


def test_unmatched_lines_go_before_the_next_shuffle(spark, options):
    options(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"
    )
    sources = retail.load_sources(spark, registered.SMOKE_DIR)
    fact = warehouse.build_table("fact_order_sales", sources, loaded(), branches=Branches())
    text = fact._jdf.queryExecution().optimizedPlan().toString()
    product, order = (text.index(f"Join LeftOuter, ({key}#") for key in ("product_code", "order_number"))
    between = text[product:order]
    assert product < order and "Filter (isnotnull(branch_matched" in between and "CollectMetrics" in between
    scan = next(
        line for line in fact._jdf.queryExecution().executedPlan().toString().splitlines()
        if "FileScan parquet [l_orderkey" in line
    )
    read = {column.split("#")[0] for column in scan.split("[")[1].split("]")[0].split(",")}
    assert read == {"l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"}
