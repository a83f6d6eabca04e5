"""Facts: order lines and payments with surrogate foreign keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import (
    AMOUNT,
    PRICE,
    KeyScheme,
    cost_amount,
    date_key,
    gross_amount,
    hash_key,
    margin_amount,
    nullable_hash_key,
)
from ledgerloom.operators.branches import Branches, inner_join
from ledgerloom.operators.sizing import is_small, shuffle_if_large

DEFAULT_KEYS = KeyScheme.XXHASH64

# Columns by which stored facts are cut into partitions.
ORDER_YEAR, PAYMENT_YEAR = "order_year", "payment_year"

# Fixed value: the order status that never becomes a sale.
CANCELLED = "Cancelled"


def not_cancelled(orders: DataFrame) -> DataFrame:
    """Orders of any other status; an unknown (NULL) status drops out too."""
    return orders.where(F.col("status") != CANCELLED)


def with_rep_office(customers: DataFrame, employees: DataFrame) -> DataFrame:
    """Customers with the office of their representative; kept when there is none."""
    reps = employees.select(
        F.col("employee_number").alias("sales_rep_employee_number"),
        F.col("office_code").alias("rep_office_code"),
    )
    return customers.join(reps, "sales_rep_employee_number", "left")


def sold_lines(
    orderdetails: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    employees: DataFrame,
    branches: Branches | None = None,
) -> DataFrame:
    """The lines of orders that were not cancelled with their header and product, before any column is computed.

    Representative and customer are joined at customer and order grain, so that the lines, by
    far the largest table, are shuffled only for their own two keys. Hot orders, customers and
    products are split by AQE: every join here is inner or left with the big side on the left.
    Representatives and products are measured here, so that none is broadcast that only looks small on disk.
    ``branches`` counts the lines that enter and those without an order that counts or a product.
    """
    reps = shuffle_if_large(employees.select("employee_number", "office_code"))
    buyers = with_rep_office(customers.select("customer_number", "sales_rep_employee_number"), reps)
    headers = (
        not_cancelled(orders)
        .select(
            "order_number",
            "customer_number",
            "order_date",
            "required_date",
            "shipped_date",
            "status",
        )
        .join(buyers, "customer_number")
    )
    prices = products.select(
        "product_code", F.col("buy_price").cast(PRICE), F.col("msrp").cast(PRICE)
    )
    lines = orderdetails
    if branches is not None:
        lines = branches.enter(
            lines.select("order_number", "product_code", "order_line_number", "quantity_ordered", "price_each")
        )
    if is_small(prices):
        sold = inner_join(lines, headers, "order_number", branches, "no_order")
        return inner_join(sold, prices, "product_code", branches, "no_product")
    # two prices are less to shuffle than a header, and rows in the order of their orders compress better
    priced = inner_join(lines, prices.hint("merge"), "product_code", branches, "no_product")
    return inner_join(priced, headers, "order_number", branches, "no_order")


def sales_columns(loaded_at: Column, keys: KeyScheme = DEFAULT_KEYS) -> list[Column]:
    """The sales fact as columns over sold lines."""
    quantity = F.col("quantity_ordered").cast("int")
    price = F.col("price_each").cast(PRICE)
    unit_cost = F.col("buy_price")
    return [
        F.concat(
            F.col("order_number").cast("string"),
            F.lit("-"),
            F.col("product_code").cast("string"),
        ).alias("sales_line_id"),
        F.col("order_number"),
        F.col("order_line_number"),
        hash_key(F.col("customer_number"), keys).alias("customer_key"),
        hash_key(F.col("product_code"), keys).alias("product_key"),
        nullable_hash_key(F.col("sales_rep_employee_number"), keys).alias(
            "sales_rep_employee_key"
        ),
        nullable_hash_key(F.col("rep_office_code"), keys).alias("sales_office_key"),
        date_key(F.col("order_date")).alias("order_date_key"),
        date_key(F.col("required_date")).alias("required_date_key"),
        date_key(F.col("shipped_date")).alias("shipped_date_key"),
        F.col("order_date"),
        F.col("required_date"),
        F.col("shipped_date"),
        F.col("status").alias("order_status"),
        quantity.alias("quantity_ordered"),
        price.alias("price_each"),
        F.col("buy_price"),
        F.col("msrp"),
        gross_amount(quantity, price).alias("gross_sales_amount"),
        cost_amount(quantity, unit_cost).alias("cost_amount"),
        margin_amount(quantity, price, unit_cost).alias("margin_amount"),
        loaded_at.alias("etl_loaded_at"),
    ]


def recomputed_sales_columns(columns: Sequence[str]) -> list[Column]:
    """The sales fact over rows of its own: what follows from other columns of a row is computed from them."""
    quantity, price, unit_cost = (F.col(c) for c in ("quantity_ordered", "price_each", "buy_price"))
    computed = {
        "order_date_key": date_key(F.col("order_date")),
        "required_date_key": date_key(F.col("required_date")),
        "shipped_date_key": date_key(F.col("shipped_date")),
        "gross_sales_amount": gross_amount(quantity, price),
        "cost_amount": cost_amount(quantity, unit_cost),
        "margin_amount": margin_amount(quantity, price, unit_cost),
    }
    return [computed[c].alias(c) if c in computed else F.col(c) for c in columns]


def fact_order_sales(
    orderdetails: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    employees: DataFrame,
    loaded_at: Column,
    keys: KeyScheme = DEFAULT_KEYS,
    branches: Branches | None = None,
) -> DataFrame:
    """One row per line of an order that was not cancelled."""
    lines = sold_lines(orderdetails, orders, customers, products, employees, branches)
    return lines.select(*sales_columns(loaded_at, keys))


def payers(customers: DataFrame) -> DataFrame:
    return customers.select("customer_number", "sales_rep_employee_number")


def payment_columns(loaded_at: Column, keys: KeyScheme = DEFAULT_KEYS) -> list[Column]:
    """The payments fact as columns over payments joined with their payers."""
    return [
        F.concat(
            F.col("customer_number").cast("string"), F.lit("-"), F.col("check_number")
        ).alias("payment_id"),
        F.col("customer_number"),
        F.col("check_number"),
        hash_key(F.col("customer_number"), keys).alias("customer_key"),
        nullable_hash_key(F.col("sales_rep_employee_number"), keys).alias(
            "sales_rep_employee_key"
        ),
        date_key(F.col("payment_date")).alias("payment_date_key"),
        F.col("payment_date"),
        F.col("amount").cast(AMOUNT).alias("payment_amount"),
        loaded_at.alias("etl_loaded_at"),
    ]


def fact_payments(
    payments: DataFrame,
    customers: DataFrame,
    loaded_at: Column,
    keys: KeyScheme = DEFAULT_KEYS,
    branches: Branches | None = None,
) -> DataFrame:
    """One row per payment of a known customer; ``branches`` counts those of others."""
    if branches is not None:
        payments = branches.enter(
            payments.select("customer_number", "check_number", "payment_date", "amount")
        )
    paid = inner_join(payments, payers(customers), "customer_number", branches, "no_customer")
    return paid.select(*payment_columns(loaded_at, keys))
