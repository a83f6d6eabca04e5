"""Dimensions: one row per entity, rebuilt in full."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import AMOUNT, PRICE, KeyScheme, date_key, hash_key, nullable_hash_key
from ledgerloom.operators.sizing import broadcast_if_small

DEFAULT_KEYS = KeyScheme.XXHASH64


def dim_customer(
    customers: DataFrame, loaded_at: Column, keys: KeyScheme = DEFAULT_KEYS
) -> DataFrame:
    rep = F.col("sales_rep_employee_number")
    return customers.select(
        hash_key(F.col("customer_number"), keys).alias("customer_key"),
        "customer_number",
        "customer_name",
        "contact_first_name",
        "contact_last_name",
        "phone",
        "address_line1",
        "address_line2",
        "city",
        "state",
        "postal_code",
        "country",
        nullable_hash_key(rep, keys).alias("sales_rep_employee_key"),
        rep,
        F.col("credit_limit").cast(AMOUNT).alias("credit_limit"),
        loaded_at.alias("etl_loaded_at"),
    )


def dim_product(
    products: DataFrame,
    productlines: DataFrame,
    loaded_at: Column,
    keys: KeyScheme = DEFAULT_KEYS,
) -> DataFrame:
    """Products with the text of their line; a product of an undescribed line stays."""
    lines = productlines.select(
        "product_line", F.col("text_description").alias("product_line_description")
    )
    return products.join(broadcast_if_small(lines), "product_line", "left").select(
        hash_key(F.col("product_code"), keys).alias("product_key"),
        "product_code",
        "product_name",
        "product_line",
        "product_line_description",
        "product_scale",
        "product_vendor",
        "product_description",
        F.col("quantity_in_stock").cast("int").alias("quantity_in_stock"),
        F.col("buy_price").cast(PRICE).alias("buy_price"),
        F.col("msrp").cast(PRICE).alias("msrp"),
        loaded_at.alias("etl_loaded_at"),
    )


def dim_employee(
    employees: DataFrame, loaded_at: Column, keys: KeyScheme = DEFAULT_KEYS
) -> DataFrame:
    """The manager key is the hash of the manager's number: no self join."""
    return employees.select(
        hash_key(F.col("employee_number"), keys).alias("employee_key"),
        "employee_number",
        "first_name",
        "last_name",
        F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("full_name"),
        "extension",
        "email",
        "job_title",
        nullable_hash_key(F.col("reports_to"), keys).alias("manager_employee_key"),
        "reports_to",
        hash_key(F.col("office_code"), keys).alias("office_key"),
        "office_code",
        loaded_at.alias("etl_loaded_at"),
    )


def dim_office(offices: DataFrame, loaded_at: Column, keys: KeyScheme = DEFAULT_KEYS) -> DataFrame:
    return offices.select(
        hash_key(F.col("office_code"), keys).alias("office_key"),
        "office_code",
        "city",
        "phone",
        "address_line1",
        "address_line2",
        "state",
        "country",
        "postal_code",
        "territory",
        loaded_at.alias("etl_loaded_at"),
    )


def date_bounds(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """First and last day over order, required, shipped and payment dates, in one row.

    Each table is read once and reduced to one row before the two meet; NULL days are skipped.
    """
    days = ("order_date", "required_date", "shipped_date")
    of_orders = orders.agg(
        F.least(*[F.min(d) for d in days]).alias("min_date"),
        F.greatest(*[F.max(d) for d in days]).alias("max_date"),
    )
    of_payments = payments.agg(
        F.min("payment_date").alias("min_date"), F.max("payment_date").alias("max_date")
    )
    return of_orders.unionByName(of_payments).agg(
        F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date")
    )


def calendar_columns(day: Column) -> list[Column]:
    """The calendar attributes of a day, Sunday being weekday 1."""
    return [
        date_key(day).alias("date_key"),
        day.alias("calendar_date"),
        F.year(day).alias("calendar_year"),
        F.quarter(day).alias("calendar_quarter"),
        F.month(day).alias("calendar_month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.coalesce(F.dayofweek(day).isin(1, 7), F.lit(False)).alias("is_weekend"),
    ]


def dim_date(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per day between the bounds; no rows without any date.

    The row count follows the calendar span, not the data, so one task generates it.
    """
    days = date_bounds(orders, payments).select(
        F.explode(F.sequence("min_date", "max_date", F.expr("interval 1 day"))).alias("day")
    )
    return days.select(*calendar_columns(F.col("day")))
