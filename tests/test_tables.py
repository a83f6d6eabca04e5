from datetime import date, datetime, timezone
from decimal import Decimal as D

import pytest
import samples
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from ledgerloom.functions import KeyScheme, hash_key
from ledgerloom.operators import dimensions, facts
from ledgerloom.plans import warehouse
from ledgerloom.sources import SOURCES, conform, require_columns

MOMENT = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def tables(spark):
    return warehouse.build_all(samples.sources(spark), warehouse.load_time(MOMENT))


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_dim_customer(tables):
    table = tables["dim_customer"]
    assert table.count() == 4
    types = dict(table.dtypes)
    assert types["customer_key"] == types["sales_rep_employee_key"] == "bigint"
    assert types["credit_limit"] == "decimal(12,2)"
    no_rep = table.where("customer_number = 2").first()
    assert no_rep.sales_rep_employee_key is None and no_rep.credit_limit is None
    assert table.select("etl_loaded_at").distinct().count() == 1


def test_dim_product_keeps_products_without_line_text(tables):
    table = tables["dim_product"]
    assert rows(table, "product_code", "product_line_description") == [
        ("S1", "All cars"),
        ("S2", None),
    ]
    types = dict(table.dtypes)
    assert types["quantity_in_stock"] == "int" and types["buy_price"] == "decimal(10,2)"


def test_dim_employee(tables):
    by_number = {r.employee_number: r for r in tables["dim_employee"].collect()}
    assert by_number[10].full_name == "Ada Moreau"
    assert by_number[10].manager_employee_key is None
    assert by_number[11].manager_employee_key == by_number[10].employee_key


def test_full_name_is_null_if_a_part_is(spark):
    people = [(1, None, "Ada", "x", "e", "1", None, "t")]
    source = samples.sources(spark, employees=people)["employees"]
    table = dimensions.dim_employee(source, F.lit(None).cast("timestamp"))
    assert table.first().full_name is None


def test_dim_office_and_key_agreement(tables):
    offices = {r.office_code: r.office_key for r in tables["dim_office"].collect()}
    staff = {r.office_code: r.office_key for r in tables["dim_employee"].collect()}
    assert offices == staff


def test_dim_date_spans_all_dates(tables):
    table = tables["dim_date"].orderBy("date_key").collect()
    assert (table[0].calendar_date, table[-1].calendar_date) == (
        date(2020, 1, 31),
        date(2020, 3, 20),
    )
    assert len(table) == 50
    leap = next(r for r in table if r.date_key == 20200229)
    assert (leap.calendar_year, leap.calendar_quarter, leap.calendar_month) == (2020, 1, 2)
    assert (leap.month_name, leap.day_name) == ("February", "Saturday")
    assert (leap.day_of_month, leap.day_of_week, leap.is_weekend) == (29, 7, True)
    monday = next(r for r in table if r.date_key == 20200302)
    assert (monday.day_of_week, monday.is_weekend) == (2, False)


def test_fact_order_sales_rows(tables):
    fact = tables["fact_order_sales"]
    # Gone: cancelled (102), unknown status (103), unknown customer (105), unknown product (S9).
    assert rows(fact, "sales_line_id") == [("100-S1",), ("100-S2",), ("101-S1",), ("104-S2",)]
    amounts = rows(
        fact, "sales_line_id", "gross_sales_amount", "cost_amount", "margin_amount"
    )
    assert amounts == [
        ("100-S1", D("45.00"), D("30.00"), D("15.00")),
        ("100-S2", D("4.00"), D("6.66"), D("-2.66")),
        ("101-S1", D("12.34"), D("10.00"), D("2.34")),
        ("104-S2", D("20.00"), D("13.32"), D("6.68")),
    ]
    types = dict(fact.dtypes)
    for column in ("gross_sales_amount", "cost_amount", "margin_amount"):
        assert types[column] == "decimal(12,2)"
    for column in ("order_date_key", "required_date_key", "shipped_date_key"):
        assert types[column] == "int"


def test_fact_order_sales_nullable_keys(tables):
    by_line = {r.sales_line_id: r for r in tables["fact_order_sales"].collect()}
    served, no_rep, strange_rep = (by_line[i] for i in ("100-S1", "101-S1", "104-S2"))
    assert served.sales_rep_employee_key is not None and served.sales_office_key is not None
    assert served.shipped_date_key == 20200301
    assert no_rep.sales_rep_employee_key is None and no_rep.sales_office_key is None
    assert no_rep.shipped_date_key is None and no_rep.shipped_date is None
    assert strange_rep.sales_rep_employee_key is not None
    assert strange_rep.sales_office_key is None


def test_fact_keys_equal_dimension_keys(spark):
    for scheme in KeyScheme:
        t = warehouse.build_all(samples.sources(spark), warehouse.load_time(MOMENT), scheme)
        fact = t["fact_order_sales"]
        assert fact.join(t["dim_customer"], "customer_key", "left_anti").count() == 0
        assert fact.join(t["dim_product"], "product_key", "left_anti").count() == 0


def test_fact_payments(tables):
    assert rows(
        tables["fact_payments"], "payment_id", "payment_date_key", "payment_amount"
    ) == [("1-C1", 20200320, D("49.00")), ("2-C2", 20200131, D("12.34"))]


def test_no_sources_give_empty_tables(spark):
    t = warehouse.build_all(samples.empty_sources(spark), warehouse.load_time(MOMENT))
    assert {name: df.count() for name, df in t.items()} == dict.fromkeys(warehouse.TABLES, 0)


def test_amount_overflow_is_an_error(spark):
    lines = [(100, "S1", 2_000_000_000, D("99999999.99"), 1)]
    source = samples.sources(spark, orderdetails=lines)
    fact = warehouse.build_table("fact_order_sales", source, warehouse.load_time(MOMENT))
    with pytest.raises(ArithmeticException):
        fact.collect()


def test_status_filter_drops_unknown_status(spark):
    kept = facts.not_cancelled(samples.sources(spark)["orders"])
    assert rows(kept, "order_number") == [(100,), (101,), (104,), (105,)]


def test_sources_take_their_declared_form(spark):
    raw = spark.createDataFrame(
        [("1", "Lyon", "a text nobody reads")], "ORDERNUMBER string, city string, extra string"
    )
    with pytest.raises(ValueError, match="orderDate"):
        conform(raw, SOURCES["orders"])
    lines = spark.createDataFrame([("Cars", "All", "<p>")], "productLine string, "
                                  "textDescription string, htmlDescription string")
    assert conform(lines, SOURCES["productlines"]).columns == ["product_line", "text_description"]
    with pytest.raises(ValueError, match="textDescription|text_description"):
        require_columns(lines.select("productLine"), SOURCES["productlines"])


def test_declared_types_decide_the_key(spark):
    loaded = spark.createDataFrame([(1,)], "id bigint")
    declared = loaded.select(F.col("id").cast("int"))
    as_read, as_declared = (
        df.select(hash_key(F.col("id"), KeyScheme.MURMUR32)).first()[0]
        for df in (loaded, declared)
    )
    assert as_read != as_declared
