"""Quality gates over sources and warehouse tables, each a small result table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.dimensions import date_bounds
from ledgerloom.operators.facts import not_cancelled


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    )


def key_uniqueness(tables: Mapping[str, tuple[DataFrame, tuple[str, ...]]]) -> DataFrame:
    """Rows, distinct keys and keys held by several rows, per table.

    Copies of a key collapse on the executors that read them, before the shuffle.
    """
    return _union(
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
            F.count(F.lit(1)).alias("distinct_keys"),
            _count_if(F.col("copies") > 1).alias("duplicate_keys"),
        )
        .select(F.lit(name).alias("table_name"), "row_count", "distinct_keys", "duplicate_keys")
        for name, (df, keys) in tables.items()
    )


def key_collisions(dimensions: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Surrogate keys that stand for more than one natural key.

    Per dimension: the frame, its natural and its surrogate key column. Smallest and largest
    natural key per surrogate suffice, so nothing is expanded or counted distinct.
    """
    return _union(
        df.groupBy(surrogate)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(natural).alias("lowest"),
            F.max(natural).alias("highest"),
        )
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
            F.count(F.lit(1)).alias("distinct_keys"),
            _count_if(F.col("lowest") != F.col("highest")).alias("colliding_keys"),
        )
        .select(F.lit(name).alias("table_name"), "row_count", "distinct_keys", "colliding_keys")
        for name, (df, natural, surrogate) in dimensions.items()
    )


# Which fact column points to which dimension column.
FOREIGN_KEYS = (
    ("fact_order_sales", "customer_key", "dim_customer", "customer_key"),
    ("fact_order_sales", "product_key", "dim_product", "product_key"),
    ("fact_order_sales", "sales_rep_employee_key", "dim_employee", "employee_key"),
    ("fact_order_sales", "sales_office_key", "dim_office", "office_key"),
    ("fact_order_sales", "order_date_key", "dim_date", "date_key"),
    ("fact_order_sales", "required_date_key", "dim_date", "date_key"),
    ("fact_order_sales", "shipped_date_key", "dim_date", "date_key"),
    ("fact_payments", "customer_key", "dim_customer", "customer_key"),
    ("fact_payments", "sales_rep_employee_key", "dim_employee", "employee_key"),
    ("fact_payments", "payment_date_key", "dim_date", "date_key"),
)


def fact_dim_integrity(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and keys of each foreign key that its dimension lacks; NULL keys count apart.

    Every table is read once. The foreign keys of a fact row are stacked and shrink to one row
    per column and key before the shuffle; a single join then meets the keys of all dimensions.
    """
    columns = ("fact_table", "fact_column", "dimension_table")

    def used(fact: str) -> DataFrame:
        keys = F.array(
            *[
                F.struct(
                    F.lit(column).alias("fact_column"),
                    F.lit(dimension).alias("dimension_table"),
                    F.col(column).cast("bigint").alias("key"),
                )
                for name, column, dimension, _ in FOREIGN_KEYS
                if name == fact
            ]
        )
        stacked = tables[fact].select(F.lit(fact).alias("fact_table"), F.inline(keys))
        return stacked.groupBy(*columns, "key").agg(F.count(F.lit(1)).alias("fact_rows"))

    facts = dict.fromkeys(fact for fact, *_ in FOREIGN_KEYS)
    dimensions = dict.fromkeys((dimension, key) for *_, dimension, key in FOREIGN_KEYS)
    known = _union(
        tables[d].select(F.lit(d).alias("dimension_table"), F.col(k).cast("bigint").alias("key"))
        for d, k in dimensions
    ).distinct()
    found = _union(used(fact) for fact in facts).join(
        known.withColumn("known", F.lit(True)), ["dimension_table", "key"], "left"
    )
    no_key = F.col("key").isNull()
    stray = ~no_key & F.col("known").isNull()
    counted = found.groupBy(*columns).agg(
        F.sum(F.when(no_key, F.col("fact_rows"))).alias("null_rows"),
        F.sum(F.when(stray, F.col("fact_rows"))).alias("stray_rows"),
        _count_if(stray).alias("stray_keys"),
    )
    # an empty fact has a row for each of its foreign keys, too
    checks = counted.sparkSession.createDataFrame(
        [(f, c, d) for f, c, d, _ in FOREIGN_KEYS], ", ".join(f"{c} string" for c in columns)
    )
    counts = ("null_rows", "stray_rows", "stray_keys")
    return checks.join(counted, list(columns), "left").select(
        *columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in counts]
    )


def expected_counts(
    sources: Mapping[str, DataFrame], counted: Mapping[str, int] | None = None
) -> DataFrame:
    """Rows each warehouse table should hold, from the sources alone.

    ``counted`` are those of tables whose joins counted on their way; their sources are not read again.
    """
    counted = counted or {}
    bounds = date_bounds(sources["orders"], sources["payments"])
    days = bounds.select(
        F.lit("dim_date").alias("table_name"),
        F.coalesce(F.datediff("max_date", "min_date") + 1, F.lit(0))
        .cast("bigint")
        .alias("row_count"),
    )
    customers = sources["customers"].select("customer_number")
    sold = not_cancelled(sources["orders"]).join(customers, "customer_number", "left_semi")
    lines = sources["orderdetails"].select("order_number", "product_code")
    recounted = row_counts(
        {
            name: rows
            for name, rows in {
                "dim_customer": customers,
                "dim_product": sources["products"],
                "dim_employee": sources["employees"],
                "dim_office": sources["offices"],
                "fact_order_sales": lines.join(
                    sold.select("order_number"), "order_number", "left_semi"
                ).join(sources["products"].select("product_code"), "product_code", "left_semi"),
                "fact_payments": sources["payments"].join(customers, "customer_number", "left_semi"),
            }.items()
            if name not in counted
        }
    )
    seen = recounted.sparkSession.createDataFrame(list(counted.items()), recounted.schema)
    return recounted.unionByName(seen).unionByName(days)


def target_counts(
    sources: Mapping[str, DataFrame],
    stored: Mapping[str, DataFrame],
    counted: Mapping[str, int] | None = None,
) -> DataFrame:
    """Expected and stored rows per warehouse table."""
    expected = expected_counts(sources, counted).withColumnRenamed("row_count", "expected_rows")
    actual = row_counts(stored).withColumnRenamed("row_count", "stored_rows")
    return expected.join(actual, "table_name", "full").select(
        "table_name",
        "expected_rows",
        "stored_rows",
        F.col("expected_rows").eqNullSafe(F.col("stored_rows")).alias("matches"),
    )


# Report measure and the fact column it sums.
REPORT_MEASURES = (
    ("units_sold", "quantity_ordered"),
    ("gross_revenue", "gross_sales_amount"),
    ("margin", "margin_amount"),
)
TOTAL = "decimal(38,2)"


def report_reconciles(report: DataFrame, fact_order_sales: DataFrame) -> DataFrame:
    """Totals of the revenue report against totals of the fact, per measure."""

    def totals(df: DataFrame, columns: list[tuple[str, str]], side: str) -> DataFrame:
        summed = df.agg(*[F.sum(column).cast(TOTAL).alias(m) for m, column in columns])
        return summed.unpivot([], [m for m, _ in columns], "measure", side)

    of_report = totals(report, [(m, m) for m, _ in REPORT_MEASURES], "report_total")
    of_fact = totals(fact_order_sales, list(REPORT_MEASURES), "fact_total")
    return of_report.join(of_fact, "measure").withColumn(
        "matches", F.col("report_total").eqNullSafe(F.col("fact_total"))
    )


def require_all(audit: DataFrame, failed: Column, what: str) -> None:
    """Raise if an audit table holds a failed row, naming the rows; audits are small."""
    rows = audit.where(failed).collect()
    if rows:
        raise RuntimeError(f"{what}: {[r.asDict() for r in rows]}")
