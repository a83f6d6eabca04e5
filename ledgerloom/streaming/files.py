"""File streams over parquet tables that grow by new files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES_PER_BATCH = 1_000

# When and by which file a row was delivered; rows of one file were delivered together.
DELIVERY = ("delivered_at", "delivered_by")


def as_glob(path: str) -> str:
    """A glob that matches this path alone.

    A file stream takes a plain path for a folder only, and a table may be one file; so one
    character becomes a class of itself. Signs that mean something in globs are escaped.
    """
    path = path.rstrip("/")
    last = max((i for i, c in enumerate(path) if c.isalnum()), default=None)
    escaped = [f"\\{c}" if c in "*?[]{}\\" else c for c in path]
    if last is not None:
        escaped[last] = f"[{path[last]}]"
    return "".join(escaped)


def table_stream(
    spark: SparkSession,
    path: str,
    files_per_batch: int = FILES_PER_BATCH,
    with_delivery: bool = False,
) -> DataFrame:
    """Stream of a parquet table's files, each once, with the schema the table has now.

    ``with_delivery`` adds the columns of ``DELIVERY``, from the file's modification time and path.
    """
    schema = spark.read.parquet(path).schema
    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(as_glob(path))
    )
    if not with_delivery:
        return stream
    at, by = DELIVERY
    return stream.select(
        *schema.names,
        F.col("_metadata.file_modification_time").alias(at),
        F.col("_metadata.file_path").alias(by),
    )
