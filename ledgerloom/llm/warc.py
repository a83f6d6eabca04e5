"""WARC archives of pages: written as monolithic gzip files, normalised, read back.

* ``write_archives`` writes records of a partition into whole-file gzip streams, as many tools do.
* ``normalise_archives`` inflates each such stream once and rewrites every record as a gzip member
  of its own, with a sidecar file that has the offset and length of each record.
* ``read_archives`` reads records by that index: an archive is split between tasks at member
  boundaries, and a single record can be fetched without what stands before it.

Files are read and written through Arrow file systems, so their folder can be local, shared or in
an object store; it must be one that all executors reach. A file gets its name from the task
attempt and is listed in a table only if the attempt succeeds, so lost or repeated tasks leave no
trace in what is read. A stream is handled in pieces; what is in memory is one record.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh_name, same, ship, stage
from ledgerloom.session import new_folder

MIN_REVISIT_BYTES = 1000
# Bytes of records per archive, before compression.
ARCHIVE_BYTES = 64 * 1024 * 1024
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"

VERSION = b"WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


# --- records -------------------------------------------------------------------------------


# Tasks that read archives back; beyond, a task reads several pieces.
MOST_TASKS = 100_000


def record_id(key: str) -> str:
    return f"<urn:x-page:{key}>"


def _head(fields: list[tuple[str, str]]) -> bytes:
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in fields)]
    return b"\r\n".join(lines) + b"\r\n\r\n"


def _clean(value: str) -> str:
    """A header value: no line breaks."""
    return " ".join(value.split())


def warc_record(key: str, url: str, payload: bytes, refers_to: str | None) -> bytes:
    """A response with its payload, or a revisit of the record ``refers_to`` without it."""
    digest = hashlib.sha1(payload).hexdigest()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(key)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _clean(url)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    block = http if refers_to is not None else http + payload
    return _head([*fields, ("Content-Length", str(len(block)))]) + block + b"\r\n\r\n"


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Fields, block and raw bytes of each record of an inflated stream."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"a record starts with {line[:40]!r}")
        raw, fields = [line], {}
        while True:
            line = stream.readline()
            raw.append(line)
            if line in (b"\r\n", b"\n"):
                break
            if not line:
                raise ValueError("a record ends in its head")
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("a record ends in its block")
        yield fields, block, b"".join(raw) + block + b"\r\n\r\n"


def payload_of(fields: dict[str, str], block: bytes) -> tuple[bytes | None, int, str]:
    """Payload (None for a revisit), its full length and its SHA-1."""
    head, _, payload = block.partition(b"\r\n\r\n")
    length = next(
        int(line.split(b":")[1])
        for line in head.split(b"\r\n")
        if line.lower().startswith(b"content-length:")
    )
    if fields["warc-type"] == "revisit":
        return None, length, fields["warc-payload-digest"].removeprefix("sha1:")
    return payload, len(payload), hashlib.sha1(payload).hexdigest()


def key_of(reference: str) -> str:
    return reference.removeprefix("<urn:x-page:").removesuffix(">")


# --- files ---------------------------------------------------------------------------------


def _open(path: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pa.fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pa.fs.FileSystem.from_uri(path)


def _attempt_name() -> str:
    task = TaskContext.get()
    return f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"


class _Inflated(io.RawIOBase):
    """Reads through all members of a gzip file, in pieces."""

    def __init__(self, source) -> None:
        self._source, self._inflate, self._rest = source, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while True:
            if self._inflate.eof:
                self._rest = self._inflate.unused_data or self._source.read(1 << 16)
                if not self._rest:
                    return 0
                self._inflate = zlib.decompressobj(31)
            data = self._rest or self._inflate.unconsumed_tail or self._source.read(1 << 16)
            self._rest = b""
            if not data:
                if not self._inflate.eof:
                    raise ValueError("an archive ends in a member")
                return 0
            out = self._inflate.decompress(data, len(buffer))
            if out:
                buffer[: len(out)] = out
                return len(out)


def inflated(source) -> io.BufferedReader:
    return io.BufferedReader(_Inflated(source), 1 << 18)


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "payload",
    refers_col: str = "refers_to",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write pages as monolithic archives; the table lists them: ``path, records``."""

    def run(batches):
        out, made, records, size = None, [], 0, 0
        files = folder.rstrip("/")
        try:
            for batch in batches:
                columns = [batch.column(c) for c in range(4)]
                for row in range(batch.num_rows):
                    if out is None:
                        path = f"{files}/whole-{_attempt_name()}.warc.gz"
                        system, local = _open(path)
                        system.create_dir(local.rsplit("/", 1)[0], recursive=True)
                        sink = system.open_output_stream(local, compression=None)
                        out, records, size = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, 0
                    key, url, payload, refers_to = (c[row].as_py() for c in columns)
                    data = warc_record(key, url or "", payload or b"", refers_to)
                    sink.write(out.compress(data))
                    records, size = records + 1, size + len(data)
                    if size >= archive_bytes:
                        sink.write(out.flush())
                        sink.close()
                        made.append((path, records))
                        out = None
            if out is not None:
                sink.write(out.flush())
                sink.close()
                made.append((path, records))
        except BaseException:
            if out is not None:
                sink.close()
            raise
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())],
            ["path", "records"],
        )

    ship(pages.sparkSession)
    rows = pages.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("key"),
        F.col(url_col).cast("string").alias("url"),
        F.col(payload_col).cast("binary").alias("payload"),
        F.col(refers_col).cast("string").alias("refers_to"),
    )
    return stage(rows.mapInArrow(run, "path string, records long"), "warc-archives")


INDEX = "path string, record long, offset long, length long, record_id string, warc_type string"


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives (column ``path``) with one gzip member per record.

    Beside each new file stands ``<file>.index.jsonl`` with a line per record; the table returned
    has the same: path, number of the record, offset and length in the file, id and type.
    Archives are dealt out one by one, each is inflated once, front to back.
    """

    def rewrite(path: str):
        system, local = _open(path)
        target = f"{folder.rstrip('/')}/members-{_attempt_name()}.warc.gz"
        target_system, target_local = _open(target)
        target_system.create_dir(target_local.rsplit("/", 1)[0], recursive=True)
        offset = 0
        with (
            system.open_input_stream(local, compression=None) as source,
            target_system.open_output_stream(target_local, compression=None) as sink,
            target_system.open_output_stream(f"{target_local}.index.jsonl") as sidecar,
        ):
            for number, (fields, _, raw) in enumerate(read_records(inflated(source))):
                member = gzip.compress(raw, LEVEL, mtime=0)
                sink.write(member)
                row = (target, number, offset, len(member), fields["warc-record-id"], fields["warc-type"])
                names = ("record", "offset", "length", "record_id", "warc_type")
                sidecar.write(json.dumps(dict(zip(names, row[1:]))).encode() + b"\n")
                yield row
                offset += len(member)

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for row in rewrite(path):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield _index_batch(rows)
                        rows = []
                yield _index_batch(rows)

    paths = archives.select("path")
    spark: SparkSession = archives.sparkSession
    ship(spark)
    dealt = paths.repartition(max(1, spark.sparkContext.defaultParallelism * 4), "path")
    return stage(dealt.mapInArrow(run, INDEX), "warc-index")


def _index_batch(rows) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["path", "record", "offset", "length", "record_id", "warc_type"]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


RECORDS = (
    "record_id string, warc_type string, target_uri string, payload binary, payload_bytes long, "
    "payload_digest string, refers_to_id string"
)
CHUNK_BYTES = 16 * 1024 * 1024


def read_archives(index: DataFrame, with_payload: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Records behind an index (whole, or any rows of it), ordered by nothing.

    Members that stand within one piece of a file are read by one task, in the order of the file.
    """

    def run(batches):
        held, source = None, None
        rows = []
        for batch in batches:
            for path, offset, length in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if path != held:
                    if source is not None:
                        source.close()
                    system, local = _open(path)
                    held, source = path, system.open_input_file(local)
                member = source.read_at(length, offset)
                fields, block, _ = next(read_records(io.BytesIO(gzip.decompress(member))))
                payload, size, digest = payload_of(fields, block)
                rows.append(
                    (
                        fields["warc-record-id"],
                        fields["warc-type"],
                        fields["warc-target-uri"],
                        payload if with_payload else None,
                        size,
                        digest,
                        fields.get("warc-refers-to"),
                    )
                )
                if len(rows) == (200 if with_payload else 10_000):
                    yield _record_batch(rows)
                    rows = []
        if source is not None:
            source.close()
        yield _record_batch(rows)

    ship(index.sparkSession)
    piece = (F.col("offset") / chunk_bytes).cast("long")
    # a task for each piece of an archive: sizes of the index say nothing of the bytes it stands for
    pieces = index.select("path", piece.alias("piece")).distinct().count()
    dealt = index.select("path", "offset", "length", piece.alias("piece")).repartition(
        max(1, min(pieces, MOST_TASKS)), "path", "piece"
    )
    ordered = dealt.sortWithinPartitions("path", "offset").select("path", "offset", "length")
    return ordered.mapInArrow(run, RECORDS)


def _record_batch(rows) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]
    names = ["record_id", "warc_type", "target_uri", "payload", "payload_bytes", "payload_digest", "refers_to_id"]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


# --- pages ---------------------------------------------------------------------------------


def with_revisits(
    pages: DataFrame,
    id_col: str = "page_id",
    payload_col: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """The rows of ``pages`` with ``payload`` (UTF-8, null: empty) and ``refers_to``.

    Of equal payloads of at least ``min_bytes`` bytes the one with the largest id is the response,
    null ids come before all others; the rest refer to it. Rows that share that id as well are
    all responses.
    """
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    digests = (
        pages.select(F.col(id_col).alias("page"), payload.alias("payload"))
        .where(F.length("payload") >= min_bytes)
        .select("page", F.unhex(F.sha2("payload", 256)).alias("digest"))
    )
    digests = stage(digests, "warc-digests")
    last = (
        digests.groupBy("digest")
        .agg(F.max("page").alias("last"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    revisit, target = fresh_name(pages, "revisit_id"), fresh_name(pages, "refers_to")
    revisits = stage(
        digests.join(last, "digest")
        .where(~same(F.col("page"), F.col("last")))
        .select(F.col("page").alias(revisit), F.col("last").alias(target), "digest")
        .distinct(),
        "warc-revisits",
    )
    digest = fresh_name(pages, "digest_of")
    own = pages.withColumn("payload", payload)
    own = own.withColumn(digest, F.unhex(F.sha2("payload", 256)))
    joined = own.join(
        revisits, same(own[id_col], F.col(revisit)) & (own[digest] == F.col("digest")), "left"
    )
    kept = [c for c in pages.columns if c.lower() not in ("payload", "refers_to")]
    return joined.select(*kept, "payload", F.col(target).alias("refers_to"))


def archive_pages(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """Archive pages and return the index of the normalised archives.

    ``folder`` (one below the shared folder if None) gets the monolithic and the normalised files.
    An empty table gives no file and an empty index.
    """
    folder = folder or new_folder(pages.sparkSession, "llm-warc")
    table = with_revisits(pages, id_col, payload_col, min_bytes)
    archives = write_archives(table, f"{folder}/whole", id_col, url_col)
    return normalise_archives(archives, f"{folder}/members")
