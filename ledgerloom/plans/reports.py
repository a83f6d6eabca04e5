"""Sales reports: star joins over facts and dimensions, run by Spark."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.facts import ORDER_YEAR

# A sum of decimal(12,2) widens to this; narrower types overflow on a large warehouse.
REVENUE = "decimal(22,2)"
TOP_CUSTOMERS = 20


def _revenue(
    fact_order_sales: DataFrame,
    dim_date: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
) -> DataFrame:
    days = dim_date.select(
        F.col("date_key").alias("order_date_key"), "calendar_year", "calendar_month"
    )
    # a stored fact lies in partitions by year: a choice of days then chooses partitions, too
    by = ["order_date_key", *(c for c in fact_order_sales.columns if c == ORDER_YEAR)]
    if len(by) > 1:
        days = days.withColumn(ORDER_YEAR, F.col("calendar_year"))
    return (
        fact_order_sales.select(
            *by,
            "customer_key",
            "product_key",
            "quantity_ordered",
            "gross_sales_amount",
            "margin_amount",
        )
        .join(days, by)
        .join(dim_customer.select("customer_key", "country"), "customer_key")
        .join(dim_product.select("product_key", "product_line"), "product_key")
        .groupBy("calendar_year", "calendar_month", "country", "product_line")
        .agg(
            F.sum("quantity_ordered").alias("units_sold"),
            F.sum("gross_sales_amount").cast(REVENUE).alias("gross_revenue"),
            F.sum("margin_amount").cast(REVENUE).alias("margin"),
        )
    )


def revenue_by_month_country_line(
    fact_order_sales: DataFrame,
    dim_date: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
) -> DataFrame:
    return _revenue(fact_order_sales, dim_date, dim_customer, dim_product).orderBy(
        "calendar_year", "calendar_month", "country", "product_line"
    )


def revenue_recent_first(
    fact_order_sales: DataFrame,
    dim_date: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
) -> DataFrame:
    """The same groups without margin, newest month first."""
    return (
        _revenue(fact_order_sales, dim_date, dim_customer, dim_product)
        .drop("margin")
        .orderBy(F.desc("calendar_year"), F.desc("calendar_month"))
    )


def revenue_between(
    fact_order_sales: DataFrame,
    dim_date: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    first: date,
    last: date,
) -> DataFrame:
    """The same groups for orders of some days. Of a stored fact only the partitions of their years
    are read: the years come from the calendar rows that the days leave, at run time."""
    days = dim_date.where(F.col("calendar_date").between(F.lit(first), F.lit(last)))
    return revenue_by_month_country_line(fact_order_sales, days, dim_customer, dim_product)


def top_customers(
    fact_order_sales: DataFrame, dim_customer: DataFrame, k: int = TOP_CUSTOMERS
) -> DataFrame:
    """The ``k`` customers with the highest gross revenue; customers of one name and country
    count as one. Ties go by name, then country.

    Sales collapse to one row per customer before the join, on the executors that read them,
    so a hot customer costs no more than any other.
    """
    per_customer = fact_order_sales.groupBy("customer_key").agg(
        F.sum("gross_sales_amount").alias("gross")
    )
    return (
        per_customer.join(
            dim_customer.select("customer_key", "customer_name", "country"), "customer_key"
        )
        .groupBy("customer_name", "country")
        .agg(F.sum("gross").cast(REVENUE).alias("gross_revenue"))
        .orderBy(F.desc("gross_revenue"), "customer_name", "country")
        .limit(k)
    )
