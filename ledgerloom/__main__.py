"""spark-submit entry: ``build`` syncs and rebuilds the warehouse, ``feed`` takes in new files of
payments or changed rows, ``report`` prints from the warehouse, ``sql`` answers a query over its tables by
name, ``expire`` deletes old versions."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from ledgerloom.functions import KeyScheme
from ledgerloom.plans import jobs
from ledgerloom.session import bucket_count, scoped_session, stored_bytes
from ledgerloom.sinks.expiry import expire
from ledgerloom.sinks.jdbc import CONNECTIONS
from ledgerloom.sinks.names import register_tables
from ledgerloom.sinks.warehouse import Warehouse
from ledgerloom.sources import SOURCES, files, jdbc


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ledgerloom")
    parser.add_argument("--warehouse", required=True, help="folder of the parquet warehouse")
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build")
    build.add_argument("--source-folder", help="parquet sources; default is the MySQL database")
    build.add_argument("--read-partitions", type=int, default=16)
    build.add_argument("--equal-height", action="store_true", help="split tables at keys that the database finds")
    build.add_argument("--database-schema", help="also replace the tables of this schema")
    build.add_argument(
        "--database-writers", type=int, default=CONNECTIONS, help="connections per table of it"
    )
    build.add_argument(
        "--keys", choices=[k.name.lower() for k in KeyScheme], default=KeyScheme.XXHASH64.name.lower()
    )
    build.add_argument(
        "--whole", action="store_true", help="join all sales lines again, not only the changed ones"
    )
    build.add_argument("--no-verify", action="store_true", help="skip the checks after the build")
    feed = commands.add_parser("feed")
    feed.add_argument("--table", required=True, choices=sorted(SOURCES))
    feed.add_argument("--order-by", nargs="*", default=[], help="columns that order changes")
    feed.add_argument("--files", required=True, help="parquet folder that grows by new files")
    report = commands.add_parser("report")
    report.add_argument("--output", help="write the whole revenue report to this folder")
    report.add_argument("--rows", type=int, default=100, help="rows of it to print")
    report.add_argument("--top", type=int, default=20)
    query = commands.add_parser("sql", help="a query over the tables by name")
    query.add_argument("query")
    query.add_argument("--output", help="write the whole result to this folder")
    query.add_argument("--rows", type=int, default=100, help="rows of it to print")
    expiry_of = commands.add_parser("expire", help="delete old versions while no other job runs")
    expiry_of.add_argument("--keep", type=int, default=2, help="versions of each table that stay")
    return parser.parse_args()


def main() -> None:
    arguments = _arguments()
    spark = SparkSession.builder.appName(f"ledgerloom-{arguments.command}").getOrCreate()
    if arguments.command == "build":
        moment = datetime.now(timezone.utc)
        run_id = jobs.new_run_id(moment)
        size = stored_bytes(spark, arguments.source_folder) if arguments.source_folder else 0
        spark = scoped_session(spark, size)
        store = Warehouse(spark, arguments.warehouse)
        if arguments.source_folder:
            snapshots = files.load_sources(spark, arguments.source_folder)
        else:
            snapshots = jdbc.load_sources(
                spark, jdbc.mysql_endpoint(), arguments.read_partitions, "CRC32({column})",
                arguments.equal_height,
            )
        landed = jobs.land(store, snapshots, f"{run_id}-sync")
        # a database can't be listed; what was read of it can
        size = size or stored_bytes(spark, *store.paths(list(landed.values())).values())
        spark = scoped_session(spark, size)
        store = Warehouse(spark, arguments.warehouse)
        jobs.sync_landed(store, landed, f"{run_id}-sync", moment, bucket_count(size))
        run = jobs.build_from_bronze if arguments.whole else jobs.refresh
        keys = KeyScheme[arguments.keys.upper()]
        counts = run(store, f"{run_id}-build", moment, keys, verify=not arguments.no_verify)
        if arguments.database_schema:
            jobs.copy_to_database(
                spark,
                store,
                jdbc.postgres_endpoint(),
                arguments.database_schema,
                arguments.database_writers,
            )
        for name, rows in counts.items():
            print(f"{name}: {rows} rows")
    elif arguments.command == "feed":
        spark = scoped_session(spark, stored_bytes(spark, arguments.files))
        store = Warehouse(spark, arguments.warehouse)
        if arguments.table == "payments":
            jobs.feed_payments(store, arguments.files, datetime.now(timezone.utc))
        else:
            jobs.feed_changes(store, arguments.table, arguments.files, arguments.order_by)
    elif arguments.command == "expire":
        gone = expire(Warehouse(spark, arguments.warehouse), arguments.keep)
        print(f"{gone.folders} folders and {gone.entries} entries deleted")
    elif arguments.command == "sql":
        current = Warehouse(spark, arguments.warehouse).tables().select("path").collect()
        spark = scoped_session(spark, stored_bytes(spark, *[r["path"] for r in current]) if current else 0)
        register_tables(Warehouse(spark, arguments.warehouse))
        result = spark.sql(arguments.query)
        if arguments.output:
            result.write.parquet(arguments.output)
            result = spark.read.parquet(arguments.output)
        result.show(arguments.rows, truncate=False)
    else:
        store = Warehouse(spark, arguments.warehouse)
        current = [r["path"] for r in store.tables().select("path").collect()]
        spark = scoped_session(spark, stored_bytes(spark, *current) if current else 0)
        store = Warehouse(spark, arguments.warehouse)
        revenue = jobs.revenue_report(store)
        if arguments.output:
            revenue.write.parquet(arguments.output)
            revenue = spark.read.parquet(arguments.output)
        total = revenue.count()
        shown = min(arguments.rows, total)
        print(f"Revenue per month, country and product line: {shown} of {total} rows")
        revenue.show(shown, truncate=False)
        print(f"The {arguments.top} customers with the highest revenue")
        jobs.top_customers_report(store, arguments.top).show(arguments.top, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
