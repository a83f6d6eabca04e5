"""Small source tables with every odd case the operators must handle."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources import SOURCES

D = Decimal




ROWS = {
    "offices": [
        ("1", "Lyon", "1", "a", None, None, "France", "69000", "EMEA"),
        ("2", "Oslo", "2", "b", "c", "d", "Norway", "0150", "EMEA"),
    ],
    "employees": [
        (10, "Moreau", "Ada", "x1", "ada@example.org", "1", None, "President"),
        (11, "Berg", "Nils", "x2", "nils@example.org", "2", 10, "Rep"),
    ],
    "customers": [
        # with a representative, without one, with one nobody knows, without any order
        (1, "Alpha", "l", "f", "p", "a", None, "Lyon", None, None, "France", 11, D("100.00")),
        (2, "Beta", "l", "f", "p", "a", None, "Oslo", None, "1", "Norway", None, None),
        (3, "Gamma", "l", "f", "p", "a", None, "Rome", "x", "2", "Italy", 99, D("5.50")),
        (4, "Delta", "l", "f", "p", "a", None, "Bonn", "x", "3", "Germany", 11, D("0.00")),
    ],
    "productlines": [("Cars", "All cars")],
    "products": [
        ("S1", "Car", "Cars", "1:10", "v", "d", 7, D("10.00"), D("20.00")),
        ("S2", "Boat", "Ships", "1:18", "v", "d", 0, D("3.33"), D("4.44")),
    ],
    "orders": [
        (100, date(2020, 2, 27), date(2020, 3, 5), date(2020, 3, 1), "Shipped", 1),
        (101, date(2020, 2, 28), date(2020, 3, 6), None, "In Process", 2),
        (102, date(2020, 2, 29), date(2020, 3, 7), None, "Cancelled", 1),
        (103, date(2020, 3, 1), date(2020, 3, 8), None, None, 1),
        (104, date(2020, 3, 2), date(2020, 3, 9), None, "On Hold", 3),
        (105, date(2020, 3, 2), date(2020, 3, 9), None, "Shipped", 77),
    ],
    "orderdetails": [
        (100, "S1", 3, D("15.00"), 1),
        (100, "S2", 2, D("2.00"), 2),
        (101, "S1", 1, D("12.34"), 1),
        (102, "S1", 9, D("9.99"), 1),
        (103, "S1", 9, D("9.99"), 1),
        (104, "S2", 4, D("5.00"), 1),
        (105, "S2", 4, D("5.00"), 1),
        (104, "S9", 4, D("5.00"), 2),
    ],
    "payments": [
        (1, "C1", date(2020, 3, 20), D("49.00")),
        (2, "C2", date(2020, 1, 31), D("12.34")),
        (77, "C3", date(2020, 3, 3), D("1.00")),
    ],
}


def sources(spark: SparkSession, **replaced: list) -> dict[str, DataFrame]:
    rows = {**ROWS, **replaced}
    return {
        name: spark.createDataFrame(
            rows[name],
            # Nullable throughout: tests feed NULLs that a checked source would not hold.
            ", ".join(f"{c.name} {c.type}" for c in table.columns),
        )
        for name, table in SOURCES.items()
    }


def empty_sources(spark: SparkSession) -> dict[str, DataFrame]:
    return sources(spark, **{name: [] for name in SOURCES})
