"""Landed micro-batches of a stream, applied to a warehouse table once per run."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators.sync import latest_or_tied, latest_per_key
from ledgerloom.sinks.warehouse import Warehouse, Written


class Landing:
    """Folder of micro-batches for one table of a warehouse.

    A micro-batch costs only its own rows: copies collapse before the shuffle and the rest is
    landed in a folder of its own, which a repeated batch overwrites. The table is then
    touched once per run, however many batches came in. Which batches of this folder it holds
    is part of the name of the run that published it, so both become visible at once, and a
    new folder starts from its own first batch.
    """

    def __init__(self, store: Warehouse, table: str, folder: str, keys: Sequence[str]) -> None:
        self.store = store
        self.table = table
        self.folder = folder.rstrip("/")
        self.keys = tuple(keys)
        self.run_prefix = f"feed-{hashlib.sha256(self.folder.encode()).hexdigest()[:16]}-through-"

    def land(
        self, stream: DataFrame, order_by: Sequence[str] = (), tied: str | None = None
    ) -> None:
        """Land everything that is there now, then stop.

        With ``tied``, landed rows say in a column of this name whether other rows of the same
        key and rank had different values.
        """

        def write(batch: DataFrame, batch_id: int) -> None:
            if tied is None:
                rows = latest_per_key(batch, self.keys, order_by)
            else:
                rows = latest_or_tied(batch, self.keys, order_by, tied)
            rows.write.mode("overwrite").parquet(
                f"{self.folder}/landed/batch_id={batch_id}"
            )

        # Gives the folder a schema before the first batch; no batch has this number.
        schema = stream.schema if tied is None else StructType(stream.schema.fields).add(tied, "boolean")
        self.store.spark.createDataFrame([], schema).write.mode("ignore").parquet(
            f"{self.folder}/landed/batch_id=-1"
        )
        query = (
            stream.writeStream.foreachBatch(write)
            .option("checkpointLocation", f"{self.folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def applied(self) -> int:
        """Number of the last batch the table holds, -1 before the first."""
        mine = (F.col("table_name") == self.table) & F.col("run_id").startswith(self.run_prefix)
        batch = F.substring_index("run_id", "-through-", -1).cast("int")
        row = self.store.versions().where(mine).agg(F.max(batch)).first()
        return -1 if row[0] is None else row[0]

    def new_rows(self) -> tuple[DataFrame, int | None]:
        """Landed rows the table does not hold yet, with their batch, and the last such batch."""
        landed = self.store.spark.read.parquet(f"{self.folder}/landed")
        rows = landed.where(F.col("batch_id") > self.applied())
        return rows, rows.agg(F.max("batch_id")).first()[0]

    def landed_batches(self) -> list[int]:
        landed = self.store.spark.read.parquet(f"{self.folder}/landed")
        return sorted(r[0] for r in landed.select("batch_id").distinct().collect())

    def settle(self, rows: DataFrame, through: int, step: str = "settled") -> DataFrame:
        """Write the rows about to be applied and read them back: they are used several times,
        and from here on a lost executor costs a read."""
        path = f"{self.folder}/{step}/through={through}"
        rows.write.mode("overwrite").parquet(path)
        return self.store.spark.read.schema(rows.schema).parquet(path)

    def run_id(self, through: int) -> str:
        return f"{self.run_prefix}{through}"

    def publish(
        self, through: int, written: list[Written], made_from: Mapping[str, str | None] | None = None
    ) -> None:
        self.store.publish(self.run_id(through), written, made_from)
