"""Run registered queries against their SQL oracles: python tests/oracle_check.py DIR [KEY...]"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as registered  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# One class of types per column kind, so that a double never passes for a decimal.
KINDS = {
    "int": "int32", "bigint": "int64", "string": "varchar", "date": "date",
    "boolean": "boolean", "double": "double", "timestamp": "timestamp",
}
DUCK_KINDS = {"INTEGER": "int32", "BIGINT": "int64"}


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 6)
    if isinstance(value, Decimal):
        return str(value)
    return value


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(
        (tuple(_plain(v) for v in row) for row in rows),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


def compare(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, key: str):
    """Rows of a query; raises where schema or values differ from the oracle."""
    result = registered.queries()[key](spark, sf_dir)
    names = sorted(result.columns)
    got = _sorted([tuple(r) for r in result.select(*names).collect()])
    relation = connection.sql(registered.oracle_sql()[key])
    types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    if sorted(types) != names:
        raise AssertionError(f"{key}: columns {names} against {sorted(types)}")
    for name, spark_type in result.dtypes:
        expected = DUCK_KINDS.get(types[name], types[name].lower())
        actual = KINDS.get(spark_type, spark_type)
        if actual != expected:
            raise AssertionError(f"{key}.{name}: {spark_type} against {types[name]}")
    quoted = ", ".join(f'"{n}"' for n in names)
    want = _sorted(relation.project(quoted).fetchall())
    if got != want:
        missing = [r for r in want if r not in set(got)][:3]
        extra = [r for r in got if r not in set(want)][:3]
        raise AssertionError(
            f"{key}: {len(got)} rows against {len(want)}; missing {missing}, extra {extra}"
        )
    return got


def main() -> None:
    sf_dir, keys = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failed = 0
    for key in keys or [k for k in registered.queries() if k in registered.oracle_sql()]:
        started = time.time()
        try:
            rows = len(compare(spark, connection, sf_dir, key))
            print(f"ok    {key:36s} {rows:8d} rows {time.time() - started:6.2f} s", flush=True)
        except Exception as error:  # report every query, then fail
            failed += 1
            print(f"FAIL  {key:36s} {str(error)[:1500]}", flush=True)
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
