"""What is shuffled to gather the years of the sales fact: no column that follows from others of its row."""

from datetime import datetime, timezone

import pytest
import samples

from ledgerloom.operators.facts import ORDER_YEAR
from ledgerloom.plans import jobs, warehouse
from ledgerloom.plans.refresh import FACT
from ledgerloom.sinks import warehouse as sink
from ledgerloom.sinks.warehouse import Warehouse

MOMENT = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
COMPUTED = {
    "order_date_key", "required_date_key", "shipped_date_key",
    "gross_sales_amount", "cost_amount", "margin_amount",
}
OF_NATURAL_KEYS = {
    "sales_line_id", "customer_key", "product_key", "sales_rep_employee_key", "sales_office_key", "etl_loaded_at",
}


@pytest.fixture
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


@pytest.fixture
def shuffled(monkeypatch):
    """Columns of each shuffle that gathers partitions, filled as tables are written."""
    seen = []
    gathered = sink.gathered

    def spy(df, layout):
        rows = gathered(df, layout)
        plan = rows._jdf.queryExecution().optimizedPlan()
        while plan.nodeName() != "RebalancePartitions":
            plan = plan.children().head()
        output = plan.output()
        seen.append({output.apply(i).name() for i in range(output.size())})
        return rows

    monkeypatch.setattr(sink, "gathered", spy)
    return seen


def sales(seen):
    return [columns for columns in seen if ORDER_YEAR in columns]


def test_a_build_gathers_joined_rows(spark, store, shuffled):
    sources = samples.sources(spark)
    loaded = warehouse.load_time(MOMENT)
    store.publish("one", warehouse.stage_all(store, "one", sources, loaded))
    (columns,) = sales(shuffled)
    assert not columns & (COMPUTED | OF_NATURAL_KEYS)
    plain = warehouse.build_table(FACT, sources, loaded)
    stored = store.read(FACT)
    assert stored.drop(ORDER_YEAR).dtypes == plain.dtypes
    assert sorted(map(str, stored.drop(ORDER_YEAR).collect())) == sorted(map(str, plain.collect()))


def test_a_refresh_gathers_rows_without_computed_columns(spark, store, shuffled):
    sources = samples.sources(spark)
    jobs.sync_sources(store, sources, "s1", MOMENT)
    jobs.build_from_bronze(store, "b1", MOMENT, verify=False)
    before = sorted(map(str, store.read(FACT).collect()))
    fewer = {**sources, "orderdetails": sources["orderdetails"].where("order_number != 100")}
    jobs.sync_sources(store, fewer, "s2", MOMENT)
    jobs.refresh(store, "b2", MOMENT, verify=False)
    refreshed = sales(shuffled)[-1]
    assert len(sales(shuffled)) == 2 and not refreshed & COMPUTED
    after = sorted(map(str, store.read(FACT).collect()))
    assert set(after) < set(before) and after


def test_table_files_are_compressed_well(spark, store):
    store.publish("one", warehouse.stage_all(store, "one", samples.sources(spark), warehouse.load_time(MOMENT)))
    for name in ("dim_customer", FACT):
        files = store.read(name).inputFiles()
        assert files and all(f.endswith(".zstd.parquet") for f in files)
