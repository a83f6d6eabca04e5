"""Order-management tables read from a retail benchmark schema.

Gives the eight source tables from region, nation, customer, supplier, part, orders, lineitem
and events. Natural keys stay BIGINT; money becomes decimal before any arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.registry import SOURCES, require_columns

# Cost share of the list price, number of sales representatives.
COST_SHARE = Decimal("0.60")
SALES_REPS = 125


# The tables of the schema that are read here.
RAW_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def raw_paths(folder: str) -> list[str]:
    return [f"{folder}/{name}.parquet" for name in RAW_TABLES]


def _raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _no_text() -> Column:
    return F.lit(None).cast("string")


def nations(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(spark, folder, "nation")


def customers_from(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Customers role of raw customer rows (a batch or a stream) and the nation table."""
    in_credit = F.col("c_acctbal") >= 0
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_number"),
        F.col("c_name").alias("customer_name"),
        _no_text().alias("contact_last_name"),
        _no_text().alias("contact_first_name"),
        _no_text().alias("phone"),
        _no_text().alias("address_line1"),
        _no_text().alias("address_line2"),
        _no_text().alias("city"),
        _no_text().alias("state"),
        _no_text().alias("postal_code"),
        F.col("n_name").alias("country"),
        F.when(in_credit, F.col("c_custkey") % SALES_REPS).alias("sales_rep_employee_number"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("credit_limit"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return customers_from(_raw(spark, folder, "customer"), nations(spark, folder))


def employees(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("s_name")
    return _raw(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("employee_number"),
        F.substring_index(name, "#", -1).alias("last_name"),
        F.substring_index(name, "#", 1).alias("first_name"),
        _no_text().alias("extension"),
        _no_text().alias("email"),
        F.col("s_nationkey").cast("bigint").alias("office_code"),
        F.when(F.col("s_suppkey") != 0, F.expr("s_suppkey div 10")).alias("reports_to"),
        _no_text().alias("job_title"),
    )


def offices(spark: SparkSession, folder: str) -> DataFrame:
    region = _raw(spark, folder, "region")
    return (
        nations(spark, folder)
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").cast("bigint").alias("office_code"),
            F.col("n_name").alias("city"),
            _no_text().alias("phone"),
            _no_text().alias("address_line1"),
            _no_text().alias("address_line2"),
            _no_text().alias("state"),
            F.col("n_name").alias("country"),
            _no_text().alias("postal_code"),
            F.col("r_name").alias("territory"),
        )
    )


def productlines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part type; PROMO stays undescribed so that the left join has a miss."""
    return (
        _raw(spark, folder, "part")
        .where(F.col("p_type") != "PROMO")
        .select(F.col("p_type").alias("product_line"))
        .distinct()
        .withColumn("text_description", F.concat(F.lit("Line "), F.col("product_line")))
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    list_price = F.col("p_retailprice").cast("decimal(10,2)")
    return _raw(spark, folder, "part").select(
        F.col("p_partkey").alias("product_code"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_line"),
        _no_text().alias("product_scale"),
        F.col("p_brand").alias("product_vendor"),
        _no_text().alias("product_description"),
        F.col("p_size").alias("quantity_in_stock"),
        (list_price * F.lit(COST_SHARE)).cast("decimal(10,2)").alias("buy_price"),
        list_price.alias("msrp"),
    )


def orders_from(raw_orders: DataFrame) -> DataFrame:
    """Orders role of raw order rows."""
    day = F.col("o_orderdate").cast("date")
    key = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    named = (
        F.when(status == "F", "Shipped")
        .when(status == "O", "In Process")
        .when(status == "P", "Cancelled")
    )
    return raw_orders.select(
        key.alias("order_number"),
        day.alias("order_date"),
        F.date_add(day, (7 + key % 4).cast("int")).alias("required_date"),
        F.when(status == "F", F.date_add(day, (1 + key % 7).cast("int"))).alias("shipped_date"),
        named.alias("status"),
        F.col("o_custkey").alias("customer_number"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return orders_from(_raw(spark, folder, "orders"))


def orderdetails(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_number"),
        F.col("l_partkey").alias("product_code"),
        F.col("l_quantity").cast("int").alias("quantity_ordered"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price_each"),
        F.col("l_linenumber").alias("order_line_number"),
    )


def payments_from(events: DataFrame) -> DataFrame:
    """Payments role of raw event rows, a batch or a stream."""
    return events.where(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("customer_number"),
        F.col("event_id").cast("string").alias("check_number"),
        F.col("ts").cast("date").alias("payment_date"),
        F.col("value").cast("decimal(12,2)").alias("amount"),
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    return payments_from(_raw(spark, folder, "events"))


READERS = {
    "offices": offices,
    "employees": employees,
    "customers": customers,
    "productlines": productlines,
    "products": products,
    "orders": orders,
    "orderdetails": orderdetails,
    "payments": payments,
}


def load_sources(
    spark: SparkSession, folder: str, names: Iterable[str] = tuple(READERS)
) -> dict[str, DataFrame]:
    return {
        name: require_columns(READERS[name](spark, folder), SOURCES[name]) for name in names
    }
