"""Warehouse tables in a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.jdbc import JdbcEndpoint, read_query

BATCH_ROWS = 10_000
# Parallel writers per table, unless the caller names a number.
CONNECTIONS = 8


def register_catalog(spark: SparkSession, name: str, endpoint: JdbcEndpoint) -> None:
    """Make the database a Spark catalog, for its namespaces and table listings."""
    prefix = f"spark.sql.catalog.{name}"
    spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    for option, value in endpoint.options().items():
        spark.conf.set(f"{prefix}.{option}", value)


def ensure_schema(spark: SparkSession, catalog: str, schema: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS `{catalog}`.`{schema}`")


def list_tables(spark: SparkSession, catalog: str, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{catalog}`.`{schema}`").select("tableName")


def write_table(
    df: DataFrame,
    endpoint: JdbcEndpoint,
    schema: str,
    table: str,
    mode: str = "overwrite",
    connections: int = CONNECTIONS,
) -> None:
    """Write by JDBC. Overwriting empties the table and keeps its definition and grants;
    ``connections`` bounds the parallel writers the database sees."""
    (
        df.write.format("jdbc")
        .mode(mode)
        .options(
            **endpoint.options(),
            dbtable=f"{schema}.{table}",
            truncate="true",
            batchsize=str(BATCH_ROWS),
            numPartitions=str(connections),
        )
        .save()
    )


def replace_table(
    df: DataFrame, endpoint: JdbcEndpoint, schema: str, table: str, connections: int = CONNECTIONS
) -> int:
    """Overwrite a table and check its row count at the database.

    A writer that is lost after its commit and run again leaves its rows twice; the check
    turns that into an error, and running the replacement again repairs it.
    """
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    write_table(counted, endpoint, schema, table, "overwrite", connections)
    rows = written.get.get("rows", 0)
    stored = read_query(
        df.sparkSession, endpoint, f"SELECT COUNT(*) AS n FROM {schema}.{table}"
    ).first()[0]
    if stored != rows:
        raise RuntimeError(f"{schema}.{table} holds {stored} rows, {rows} were written")
    return rows
