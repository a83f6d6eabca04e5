"""Relational sources over JDBC: whole tables, split tables and pushed-down queries."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.registry import SOURCES, SourceTable, conform

FETCH_ROWS = 10_000


@dataclass(frozen=True)
class JdbcEndpoint:
    url: str
    driver: str
    user: str
    password: str = field(repr=False)

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
        }


def _setting(env: Mapping[str, str], name: str, default: str | None = None) -> str:
    value = env.get(name, default)
    if value is None:
        raise KeyError(f"environment variable {name} is not set")
    return value


def mysql_endpoint(env: Mapping[str, str] = os.environ) -> JdbcEndpoint:
    host = _setting(env, "MYSQL_HOST", "localhost")
    port = _setting(env, "MYSQL_PORT", "3306")
    database = _setting(env, "MYSQL_DATABASE")
    url = f"jdbc:mysql://{host}:{port}/{database}"
    url_options = _setting(env, "MYSQL_URL_OPTIONS", "")
    return JdbcEndpoint(
        url=f"{url}?{url_options}" if url_options else url,
        driver="com.mysql.cj.jdbc.Driver",
        user=_setting(env, "MYSQL_USER"),
        password=_setting(env, "MYSQL_PASSWORD"),
    )


def postgres_endpoint(env: Mapping[str, str] = os.environ) -> JdbcEndpoint:
    host = _setting(env, "POSTGRES_DW_HOST", "localhost")
    port = _setting(env, "POSTGRES_DW_PORT", "5432")
    database = _setting(env, "POSTGRES_DW_DB")
    return JdbcEndpoint(
        url=f"jdbc:postgresql://{host}:{port}/{database}",
        driver="org.postgresql.Driver",
        user=_setting(env, "POSTGRES_DW_USER"),
        password=_setting(env, "POSTGRES_DW_PASSWORD"),
    )


@dataclass(frozen=True)
class RangeSplit:
    """Parallel read by ranges of a numeric or date column. Rows outside the bounds and NULLs
    still arrive: Spark leaves the first and last range open."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.partitions),
        }


def read_query(spark: SparkSession, endpoint: JdbcEndpoint, query: str) -> DataFrame:
    """One statement run whole by the database; its order is not kept by Spark."""
    return (
        spark.read.format("jdbc")
        .options(**endpoint.options(), query=query, fetchsize=str(FETCH_ROWS))
        .load()
    )


def read_table(
    spark: SparkSession,
    endpoint: JdbcEndpoint,
    table: str,
    split: RangeSplit | None = None,
) -> DataFrame:
    options = {**endpoint.options(), "dbtable": table, "fetchsize": str(FETCH_ROWS)}
    if split is not None:
        options.update(split.options())
    return spark.read.format("jdbc").options(**options).load()


def read_table_by_predicates(
    spark: SparkSession, endpoint: JdbcEndpoint, table: str, predicates: list[str]
) -> DataFrame:
    """One partition per predicate; together they must cover every row exactly once."""
    properties = {**endpoint.options(), "fetchsize": str(FETCH_ROWS)}
    url = properties.pop("url")
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def bucket_predicates(integer_expression: str, buckets: int) -> list[str]:
    """Predicates that spread rows by an integer expression, such as a checksum of a string key.

    NULLs and negative values land in exactly one bucket as well.
    """
    parts = [f"ABS(MOD({integer_expression}, {buckets})) = {i}" for i in range(buckets)]
    parts[0] = f"({parts[0]} OR ({integer_expression}) IS NULL)"
    return parts


def find_range(
    spark: SparkSession, endpoint: JdbcEndpoint, table: str, column: str, partitions: int
) -> RangeSplit | None:
    """Bounds of a column, asked of the database; None for an empty table."""
    bounds = read_query(
        spark, endpoint, f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    ).first()
    if bounds is None or bounds[0] is None:
        return None
    return RangeSplit(column, str(bounds[0]), str(bounds[1]), partitions)


def heights_query(table: str, key: Sequence[str], partitions: int) -> str:
    """The keys at which parts of equal height begin, in order, found by the database in its index of the key.

    Parts differ by a row at most, whatever the values of the leading column; whole numbers alone are
    compared, as databases disagree about division. A table with fewer rows gives each of them.
    """
    columns = ", ".join(key)
    placed = (
        f"SELECT {columns}, ROW_NUMBER() OVER (ORDER BY {columns}) - 1 AS key_place, "
        f"COUNT(*) OVER () AS key_rows FROM {table}"
    )
    return (
        f"SELECT {columns} FROM ({placed}) placed "
        f"WHERE MOD(key_place * {partitions}, key_rows) < {partitions} ORDER BY key_place"
    )


def literal(value: object, backslash_escapes: bool = False) -> str:
    """A value of a key in SQL; only types whose text is the same in every database."""
    if isinstance(value, (bool, datetime)) or not isinstance(value, (int, Decimal, date, str)):
        raise TypeError(f"no literal for a key of type {type(value).__name__}")
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    text = value.replace("\\", "\\\\") if backslash_escapes else value
    return "'" + text.replace("'", "''") + "'"


def _from_key_on(key: Sequence[str], values: Sequence[str]) -> str:
    """Keys not before the given one; led by a plain comparison of the first column, which an index serves."""
    column, value = key[0], values[0]
    if len(key) == 1:
        return f"{column} >= {value}"
    return f"({column} >= {value} AND ({column} > {value} OR {_from_key_on(key[1:], values[1:])}))"


def height_predicates(
    key: Sequence[str], starts: Sequence[Sequence[object]], backslash_escapes: bool = False
) -> list[str]:
    """Predicates that part rows at the given keys, in their order; each row meets exactly one.

    The first and last part are open, so rows that came since the keys were asked for arrive as well. Rows
    with a NULL in the key belong to the first part.
    """
    once = dict.fromkeys(tuple(literal(v, backslash_escapes) for v in start) for start in starts)
    bounds = [_from_key_on(key, values) for values in list(once)[1:]]
    if not bounds:
        return ["1 = 1"]
    null = " OR ".join(f"{column} IS NULL" for column in key)
    known = " AND ".join(f"{column} IS NOT NULL" for column in key)
    between = [f"({known} AND {low} AND NOT {high})" for low, high in zip(bounds, bounds[1:])]
    return [f"({null} OR NOT {bounds[0]})", *between, f"({known} AND {bounds[-1]})"]


def read_table_by_height(
    spark: SparkSession, endpoint: JdbcEndpoint, table: str, key: Sequence[str], partitions: int
) -> DataFrame:
    """A table in parts of equal height over its whole key, text or composite; as many rows as parts reach
    the driver before."""
    # one connection reads the few starts, so they arrive in the database's order, by its collation
    starts = read_query(spark, endpoint, heights_query(table, key, partitions)).collect()
    escapes = endpoint.url.startswith("jdbc:mysql:")
    return read_table_by_predicates(spark, endpoint, table, height_predicates(key, starts, escapes))


def _lead(table: SourceTable) -> tuple[str, bool]:
    """Source name of the column that leads the primary key, and whether it is numeric."""
    lead = next(c for c in table.columns if c.name == table.primary_key[0])
    return lead.source_name, lead.type in ("int", "bigint")


def load_sources(
    spark: SparkSession,
    endpoint: JdbcEndpoint,
    partitions: int = 1,
    text_bucket: str | None = None,
    equal_height: bool = False,
) -> dict[str, DataFrame]:
    """Every declared source table, each split by the column that leads its primary key.

    With ``equal_height`` tables are split over the whole primary key instead, at keys that the database gives
    for parts of as many rows: for keys with gaps, or hot in their leading column.

    Numeric keys split by range. Text keys need the database's own checksum as
    ``text_bucket``, such as ``CRC32({column})``, else their table is read by one task.
    """
    loaded = {}
    for name, table in SOURCES.items():
        column, numeric = _lead(table)
        if partitions > 1 and equal_height:
            named = {c.name: c.source_name for c in table.columns}
            key = [named[k] for k in table.primary_key]
            df = read_table_by_height(spark, endpoint, name, key, partitions)
        elif partitions > 1 and numeric:
            split = find_range(spark, endpoint, name, column, partitions)
            df = read_table(spark, endpoint, name, split)
        elif partitions > 1 and text_bucket:
            predicates = bucket_predicates(text_bucket.format(column=column), partitions)
            df = read_table_by_predicates(spark, endpoint, name, predicates)
        else:
            df = read_table(spark, endpoint, name)
        loaded[name] = conform(df, table)
    return loaded
