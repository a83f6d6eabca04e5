"""Session options and the shared folder for written intermediate tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION_BYTES = 128 * 1024 * 1024


@dataclass(frozen=True)
class Ceilings:
    """Bytes of input per shuffle partition and per scan task, up to so many of them.

    Beyond, partitions and tasks grow instead: their product is the number of shuffle blocks.
    """

    partition_bytes: int = PARTITION_BYTES
    shuffle_partitions: int = 20_000
    scan_tasks: int = 100_000
    scan_task_bytes: int = 1024 * 1024 * 1024


CEILINGS = Ceilings()

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
SCAN_BYTES = "spark.sql.files.maxPartitionBytes"
TIME_ZONE = "spark.sql.session.timeZone"


def shuffle_partitions(input_bytes: int, ceilings: Ceilings = CEILINGS) -> int:
    return min(ceilings.shuffle_partitions, -(-input_bytes // ceilings.partition_bytes))


def scan_task_bytes(input_bytes: int, ceilings: Ceilings = CEILINGS) -> int:
    per_task = -(-input_bytes // ceilings.scan_tasks)
    return min(ceilings.scan_task_bytes, max(ceilings.partition_bytes, per_task))


def bucket_count(table_bytes: int, ceilings: Ceilings = CEILINGS) -> int:
    """Buckets for a table that is to be kept in step: as many as it has shuffle partitions, 16 at least."""
    return max(16, shuffle_partitions(table_bytes, ceilings))


def recommended_options(
    input_bytes: int, cores: int, ceilings: Ceilings = CEILINGS
) -> dict[str, str]:
    """Options for a session that reads about ``input_bytes`` on ``cores`` cores.

    The initial shuffle partition count follows the input so that a partition fits in
    memory at any scale; AQE then coalesces what turns out small and splits what is hot.
    """
    partitions = str(max(cores, shuffle_partitions(input_bytes, ceilings)))
    return {
        "spark.sql.adaptive.enabled": "true",
        INITIAL_PARTITIONS: partitions,
        SHUFFLE_PARTITIONS: partitions,
        SCAN_BYTES: str(scan_task_bytes(input_bytes, ceilings)),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(ceilings.partition_bytes),
        TIME_ZONE: "UTC",
    }


def _listed(spark: SparkSession, paths: tuple[str, ...]) -> DataFrame:
    """All files below the paths, from their listing; no content is read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    )


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of all files below the paths."""
    return _listed(spark, paths).agg(F.sum("length")).first()[0] or 0


def fingerprint(spark: SparkSession, *paths: str) -> int:
    """A number that changes with the names, sizes or times of the files below the paths."""
    file = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return int(_listed(spark, paths).agg(F.sum(file)).first()[0] or 0)


def fit_shuffles(spark: SparkSession, input_bytes: int, ceilings: Ceilings = CEILINGS) -> None:
    """Raise the partitions and scan sizes of a session to those the input needs."""
    needed = shuffle_partitions(input_bytes, ceilings)
    planned = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get(SHUFFLE_PARTITIONS))
    if needed > planned:
        spark.conf.set(INITIAL_PARTITIONS, str(needed))
    scan = scan_task_bytes(input_bytes, ceilings)
    if scan > ceilings.partition_bytes:
        spark.conf.set(SCAN_BYTES, str(scan))


def scoped_session(
    spark: SparkSession, input_bytes: int, ceilings: Ceilings = CEILINGS
) -> SparkSession:
    """A session for one job: the caller's options, UTC, and sizes for its input.

    It shares the application but neither options nor temporary views with the caller's, so what ran
    before doesn't change how a job is planned, nor does the job change what the caller has set.
    """
    job = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if job.conf.get(name, None) != value and job.conf.isModifiable(name):
            job.conf.set(name, value)
    job.conf.set(TIME_ZONE, "UTC")
    fit_shuffles(job, input_bytes, ceilings)
    return job


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset, the folder lies below ``spark.sql.warehouse.dir``, which every session has.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Fresh path below the shared folder; nothing is ever overwritten in place."""
    return f"{shared_folder(spark)}/ledgerloom/{purpose}-{uuid.uuid4().hex}"
