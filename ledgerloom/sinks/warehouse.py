"""Warehouse tables as parquet, replaced in full or by partition and switched over together."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PUBLISHED = (
    "run_id string, published_at timestamp, table_name string, path string, row_count bigint, "
    "schema string, partition_column string, buckets int, replaced array<string>, parts map<string,bigint>, "
    "made_from map<string,string>, metrics map<string,bigint>"
)
# Stands for all partitions of a table in ``replaced``, and for the one part of a table without any.
ALL = "*"
# Parquet codec of table files: a quarter smaller than the default, at a few percent of the write's time.
COMPRESSION = "zstd"
RUN = "part_run"
BUCKET = "bucket"
# A partition that grows by a part per run is written anew when it has this many.
MOST_PARTS = 8


@dataclass(frozen=True)
class Written:
    """A table as a run has written it, not published yet."""

    name: str
    path: str
    rows: int
    schema: str | None = None
    partition_column: str | None = None
    buckets: int | None = None
    replaced: tuple[str, ...] = (ALL,)
    parts: Mapping[str, int] | None = None
    metrics: Mapping[str, int] | None = None


@dataclass(frozen=True)
class Layout:
    """How a table is cut into partitions: by a column that is added, or by buckets of its keys.

    The value is never NULL. ``finish`` gives the stored columns from those of the rows that are written; it
    comes after the shuffle that gathers a partition, so what it computes is not shuffled.
    """

    column: str
    value: Column
    buckets: int | None = None
    finish: Callable[[Sequence[str]], list[Column]] | None = None

    @classmethod
    def by_bucket(cls, keys: Sequence[str], buckets: int) -> Layout:
        return cls(BUCKET, bucket_of(keys, buckets), buckets)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def gathered(df: DataFrame, layout: Layout) -> DataFrame:
    """The rows by partition; columns that the layout computes come after the shuffle."""
    rows = df.withColumn(layout.column, layout.value).hint("rebalance", layout.column)
    if layout.finish is None:
        return rows
    own = [c for c in df.columns if c != layout.column]
    return rows.select(*layout.finish(own), layout.column)


@dataclass(frozen=True)
class Current:
    """A published table: its newest version and the folders of its parts, by partition."""

    path: str
    schema: str | None
    partition_column: str | None
    buckets: int | None
    parts: dict[str, list[str]]

    def touched_since(self, earlier: Current) -> list[str]:
        """Partitions that have been written or emptied since; ``ALL`` stands for all of them."""
        if (self.partition_column, self.buckets) != (earlier.partition_column, earlier.buckets):
            return [ALL]
        values = {*self.parts, *earlier.parts}
        return sorted(v for v in values if self.parts.get(v) != earlier.parts.get(v))


class Warehouse:
    """A folder of table versions and a list of the published ones.

    Every run writes new files; one small append to the list then switches all its tables at
    once. Readers see the old tables until then, and a run that dies leaves them untouched.

    A table is either written whole by every run, or cut into partitions (``Layout``). A run
    then writes only some of them, each into a folder of its own, and its entry in the list says which
    partitions it replaces and how many rows it has in each. So what a run writes goes with what changed, what a
    reader opens with the partitions it needs, and what the driver looks up with the number of partitions, not of runs.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        # An empty list makes the folder a warehouse; an existing one stays as it is.
        spark.createDataFrame([], PUBLISHED).write.mode("ignore").parquet(self.list_path)

    @property
    def list_path(self) -> str:
        return f"{self.root}/published"

    # --- writing ---------------------------------------------------------------------------

    def replace(
        self, run_id: str, tables: dict[str, DataFrame], layouts: Mapping[str, Layout] | None = None
    ) -> dict[str, int]:
        """Write the tables side by side, publish them together, give their row counts."""
        return self.publish(run_id, self.stage(run_id, tables, layouts))

    def stage(
        self, run_id: str, tables: dict[str, DataFrame], layouts: Mapping[str, Layout] | None = None
    ) -> list[Written]:
        """Write the tables in full, side by side; those with a layout are cut into partitions."""
        folder = f"{self.root}/data/{run_id}-{uuid.uuid4().hex}"

        def write(item: tuple[str, DataFrame]) -> Written:
            name, df = item
            if layouts and name in layouts:
                return self.stage_parts(run_id, name, df, layouts[name])
            path = f"{folder}/{name}"
            # Counted in the writing stage itself, so the plan runs once.
            written = Observation()
            counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
            counted.write.option("compression", COMPRESSION).parquet(path)
            return Written(name, path, written.get.get("rows", 0))

        with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
            return list(pool.map(write, tables.items()))

    def stage_parts(
        self,
        run_id: str,
        name: str,
        df: DataFrame,
        layout: Layout,
        replaced: Iterable[str] = (ALL,),
    ) -> Written:
        """Write partitions of a table. ``replaced`` are those whose older parts no longer count.

        The rows of a partition are gathered for the write; a large one is split again by AQE.
        """
        path = f"{self._table_path(name)}/{RUN}={run_id}-{uuid.uuid4().hex}"
        rows = gathered(df, layout)
        rows.write.option("compression", COMPRESSION).partitionBy(layout.column).parquet(path)
        # from the files' footers; as many rows as partitions
        counted = self.spark.read.schema(rows.schema).parquet(path).groupBy(layout.column).count()
        parts = {str(r[0]): r["count"] for r in counted.collect()}
        schema = rows.schema.json()
        total = sum(parts.values())
        return Written(name, path, total, schema, layout.column, layout.buckets, tuple(sorted(replaced)), parts)

    def stage_appended(
        self,
        run_id: str,
        name: str,
        table: Current,
        df: DataFrame,
        layout: Layout,
        most_parts: int = MOST_PARTS,
    ) -> Written:
        """Add rows to the partitions of a table as it was looked up.

        Partitions with ``most_parts`` parts are written anew with the rows they have, so that a row
        is written again only once in so many runs and a partition never has more parts.
        """
        values = {str(r[0]) for r in df.select(layout.value).distinct().collect()}
        full = sorted(v for v in values if len(table.parts.get(v, ())) >= most_parts)
        if full:
            df = self._open(name, table, full).drop(layout.column).unionByName(df)
        return self.stage_parts(run_id, name, df, layout, full)

    def publish(
        self,
        run_id: str,
        written: Sequence[Written],
        made_from: Mapping[str, str | None] | None = None,
        inputs: Mapping[str, str | None] | None = None,
    ) -> dict[str, int]:
        """Switch readers to staged tables, all at once; give the rows written.

        ``made_from`` holds the versions that the tables were derived from, as ``paths`` gave them.
        If another run has published newer ones meanwhile, this raises: their changes would be lost.
        ``inputs`` are versions of other tables that went in as well; they may have moved on. They
        are kept with the tables, for a later run that wants to know what changed since.
        """
        if made_from:
            now_current = self.paths(list(made_from), other_than_run=run_id)
            passed = sorted(n for n in made_from if now_current[n] != made_from[n])
            if passed:
                raise RuntimeError(f"another run published {', '.join(passed)} during {run_id}")
        now = datetime.now(timezone.utc)
        rows = [
            (
                run_id, now, w.name, w.path, w.rows, w.schema, w.partition_column, w.buckets,
                list(w.replaced), {ALL: w.rows} if w.parts is None else dict(w.parts),
                {k: v for k, v in (inputs or {}).items() if v is not None}, dict(w.metrics or {}),
            )
            for w in written
        ]
        self.spark.createDataFrame(rows, PUBLISHED).coalesce(1).write.mode("append").parquet(
            self.list_path
        )
        return {w.name: w.rows for w in written}

    def read_with(self, written: Written) -> DataFrame:
        """A table in partitions as it will be once this is published."""
        if ALL in written.replaced:
            return self.read_written(written)
        table = self._known(written.name, self.current([written.name]))
        kept = [v for v in table.parts if v not in written.replaced]
        return self._open(written.name, table, kept).unionByName(self.read_written(written))

    # --- the list --------------------------------------------------------------------------

    def versions(self) -> DataFrame:
        """Every published version of every table. What a run publishes again takes its former place."""
        listed = self.spark.read.schema(PUBLISHED).parquet(self.list_path)
        columns = [c for c in listed.columns if c not in ("run_id", "table_name")]
        last = F.max_by(F.struct(*columns), "published_at").alias("last")
        once = listed.groupBy("run_id", "table_name").agg(last).select("run_id", "table_name", "last.*")
        whole = F.create_map(F.lit(ALL), F.col("row_count"))
        return once.withColumns(
            {
                "replaced": F.coalesce("replaced", F.array(F.lit(ALL))),
                "parts": F.coalesce("parts", whole),
            }
        ).select(*listed.columns)

    def list_files(self) -> list[str]:
        """The files that the list consists of."""
        return self.spark.read.schema(PUBLISHED).parquet(self.list_path).inputFiles()

    def _live(self, versions: DataFrame) -> DataFrame:
        """Every partition with its parts that count, those published no earlier than what replaced it last.

        A row for each partition of a table (``ALL`` stands for a table without any, and comes for every table),
        with what its newest version says.
        """
        order = F.struct("published_at", "run_id")
        of_table = Window.partitionBy("table_name")
        whole = F.when(F.array_contains("replaced", ALL), F.col("order"))
        newest = F.struct("run_id", "published_at", "path", "schema", "partition_column", "buckets")
        since = versions.withColumn("order", order).withColumns(
            {"whole": F.max(whole).over(of_table), "newest": F.max_by(newest, "order").over(of_table)}
        )
        entries = (
            since.where(F.col("order") >= F.col("whole"))
            .withColumn("value", F.explode(F.array_union("replaced", F.map_keys("parts"))))
            .select(
                "table_name", "newest", "value", "order",
                F.when(F.array_contains("replaced", F.col("value")), F.col("order")).alias("replaces"),
                F.when(
                    F.map_contains_key("parts", F.col("value")),
                    F.struct("order", "path", F.col("parts")[F.col("value")].alias("rows")),
                ).alias("part"),
            )
        )
        by_value = entries.groupBy("table_name", "value").agg(
            F.first("newest").alias("newest"), F.max("replaces").alias("replaced"), F.collect_list("part").alias("parts")
        )
        counts = F.filter("parts", lambda part: part["order"] >= F.coalesce(F.col("replaced"), part["order"]))
        return by_value.select("table_name", "value", "newest", counts.alias("parts"))

    def tables(self) -> DataFrame:
        """The current version of every table: its last run and all rows it has."""
        rows = F.aggregate("parts", F.lit(0).cast("long"), lambda total, part: total + part["rows"])
        return (
            self._live(self.versions())
            .groupBy("table_name")
            .agg(F.first("newest").alias("newest"), F.sum(rows).alias("row_count"))
            .select("table_name", "newest.run_id", "newest.published_at", "newest.path", "row_count")
        )

    def current(
        self,
        names: Sequence[str],
        other_than_run: str | None = None,
        at: Mapping[str, str] | None = None,
    ) -> dict[str, Current]:
        """Those of some tables that are there, as they are now or were ``at`` versions, looked up
        at one moment. A row for each partition reaches the driver.
        """
        found: dict[str, Current] = {}
        for r in self._live(self._versions_of(names, other_than_run, at)).collect():
            newest = r["newest"]
            table = found.setdefault(
                r["table_name"],
                Current(newest["path"], newest["schema"], newest["partition_column"], newest["buckets"], {}),
            )
            if r["parts"]:
                table.parts[r["value"]] = [p["path"] for p in sorted(r["parts"], key=lambda p: p["order"])]
        return found

    def paths(
        self, names: Sequence[str], other_than_run: str | None = None
    ) -> dict[str, str | None]:
        """Where the last versions lie, or the newest that the given run did not write."""
        versions = self._versions_of(names, other_than_run)
        newest = F.max_by("path", F.struct("published_at", "run_id")).alias("path")
        found = versions.groupBy("table_name").agg(newest).collect()
        return dict.fromkeys(names) | {r["table_name"]: r["path"] for r in found}

    def _versions_of(
        self,
        names: Sequence[str],
        other_than_run: str | None = None,
        at: Mapping[str, str] | None = None,
    ) -> DataFrame:
        versions = self.versions().where(F.col("table_name").isin(*names))
        if other_than_run is not None:
            versions = versions.where(F.col("run_id") != other_than_run)
        if at is not None:
            order = F.struct("published_at", "run_id")
            then = versions.where(F.col("path").isin(*at.values())).select(
                F.col("table_name").alias("then_name"), order.alias("then")
            )
            no_later = (F.col("table_name") == F.col("then_name")) & (order <= F.col("then"))
            versions = versions.join(F.broadcast(then), no_later, "left_semi")
        return versions

    def made_from(self, name: str) -> dict[str, str]:
        """The versions of other tables that went into the current version (``inputs``)."""
        return self._last(name, "made_from") or {}

    def metrics(self, name: str) -> dict[str, int]:
        """What the run that published the current version counted on its way."""
        return self._last(name, "metrics") or {}

    def _last(self, name: str, column: str):
        order = F.struct("published_at", "run_id")
        return self._versions_of([name]).agg(F.max_by(column, order)).first()[0]

    def exists(self, name: str) -> bool:
        return self.paths([name])[name] is not None

    # --- reading ---------------------------------------------------------------------------

    def _table_path(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def read_all(self, *names: str) -> dict[str, DataFrame]:
        """Current versions, looked up at one moment so that they belong together."""
        found = self.current(names)
        return {n: self._open(n, self._known(n, found)) for n in names}

    def read(
        self,
        name: str,
        other_than_run: str | None = None,
        values: Iterable[str] | None = None,
        at: str | None = None,
    ) -> DataFrame:
        """The current version, the newest that the given run did not write, or the table as it was
        ``at`` a version; of a table in partitions, those with the given values, or all."""
        found = self.current([name], other_than_run, None if at is None else {name: at})
        return self._open(name, self._known(name, found), values)

    def open(self, name: str, table: Current, values: Iterable[str] | None = None) -> DataFrame:
        """A table as it was when it was looked up (``current``)."""
        return self._open(name, table, values)

    def _known(self, name: str, found: Mapping[str, Current]) -> Current:
        if name not in found:
            raise LookupError(f"no published table {name} in {self.root}")
        return found[name]

    def read_written(self, written: Written) -> DataFrame:
        """A staged table in full, as this run wrote it."""
        if written.parts is None:
            return self.spark.read.parquet(written.path)
        parts = {value: [written.path] for value in written.parts}
        return self._open(written.name, Current(written.path, written.schema, written.partition_column, None, parts))

    def _open(self, name: str, table: Current, values: Iterable[str] | None = None) -> DataFrame:
        if table.partition_column is None:
            return self.spark.read.parquet(table.path)
        chosen = None if values is None else set(values)
        folders = [
            f"{path}/{table.partition_column}={value}"
            for value, paths in table.parts.items()
            if chosen is None or ALL in chosen or value in chosen
            for path in paths
        ]
        schema = StructType.fromJson(json.loads(table.schema))
        if not folders:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.option("basePath", self._table_path(name)).schema(schema)
        return read.parquet(*folders).drop(RUN)
