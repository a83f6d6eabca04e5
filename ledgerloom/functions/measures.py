"""Exact money measures of an order line."""

from __future__ import annotations

from pyspark.sql import Column

# Decimal types of prices and of amounts in the warehouse.
PRICE = "decimal(10,2)"
AMOUNT = "decimal(12,2)"


def gross_amount(quantity: Column, price: Column) -> Column:
    return (quantity * price).cast(AMOUNT)


def cost_amount(quantity: Column, unit_cost: Column) -> Column:
    return (quantity * unit_cost).cast(AMOUNT)


def margin_amount(quantity: Column, price: Column, unit_cost: Column) -> Column:
    return (quantity * (price - unit_cost)).cast(AMOUNT)
