"""WARC archives written and read as tables of chunks.

A payload is cut into chunks before it leaves the JVM, and a record is read as rows of (record, chunk
number, bytes), so neither side holds more than a chunk of it in Python. Each chunk carries the digest of
the payload up to its end; that of the last one is the digest of the payload.

Archives are files of gzip members, one member per record, in a shared folder. A task writes to a name of its own and
renames it when it is whole, so a task that is lost and run again leaves one archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 32 << 10
READ_ROWS = 256
_NAMES = uuid.UUID("6f0e9f5c-6a57-4a35-9b5a-3d1f4b8a2c11")

WRITTEN = "file string, n_records bigint, n_bytes bigint"
CHUNKS = (
    "page_id bigint, record_id string, record_type string, refers_to bigint, url string, chunk_no bigint, "
    "chunk binary, bytes_so_far bigint, digest_so_far string, is_last boolean"
)


def record_rows(pages: DataFrame, id_column: str, payload_column: str, url_column: str | None, min_bytes: int) -> DataFrame:
    """One row per chunk to be written, in order: page, type and digest of the record, and a piece of the payload."""
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit(b""))
    url = F.col(url_column).cast("string") if url_column else F.lit(None).cast("string")
    rows = pages.select(
        F.col(id_column).cast("bigint").alias("page_id"), url.alias("url"), payload.alias("payload")
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    repeated = (
        rows.where(F.length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first")
    )
    size = F.length("payload").cast("bigint")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    typed = rows.join(repeated, "digest", "left").select(
        "page_id", "url", "digest", size.alias("size"), "payload", F.when(revisit, F.col("first")).alias("refers_to")
    )
    last = F.when(F.col("refers_to").isNull(), F.floor((F.greatest("size", F.lit(1)) - 1) / CHUNK_BYTES)).otherwise(0)
    piece = F.substring("payload", (F.col("chunk_no") * CHUNK_BYTES + 1).cast("int"), F.lit(CHUNK_BYTES))
    return typed.withColumn("chunk_no", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint")))).select(
        "page_id", "url", "digest", "size", "refers_to", "chunk_no",
        F.when(F.col("refers_to").isNull(), piece).alias("chunk"),
    )


def write_warc(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    payload_column: str = "html",
    url_column: str | None = "url",
    min_bytes: int = 0,
) -> DataFrame:
    """Write a record per row below ``folder`` and return (file, n_records, n_bytes) of the archives.

    A null payload is empty. Of records with equal payloads of at least ``min_bytes`` bytes, those with the
    smallest id are responses, the others revisits that name it; a group without any id, and shorter payloads, are all
    responses. A repeated row with the smallest id is a response again. An empty table writes no archive.
    """
    spark = pages.sparkSession
    rows = record_rows(pages, id_column, payload_column, url_column, min_bytes)
    rows.mapInArrow(lambda batches: _write(batches, folder), WRITTEN).write.parquet(f"{folder}/_written")
    return spark.read.schema(WRITTEN).parquet(f"{folder}/_written")


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, str(page_id)) if page_id is not None else uuid.uuid4()}>"


def _heads(page_id, url, digest, size, refers_to) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        f"X-Payload-Length: {size}",
    ]
    if page_id is not None:
        fields.append(f"X-Page-Id: {page_id}")
    if url:
        fields.append(f"WARC-Target-URI: {url.translate({10: '%0A', 13: '%0D'})}")
    if refers_to is not None:
        fields += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(refers_to)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    fields += ["Content-Type: application/http; msgtype=response"]
    length = len(http) + (size if refers_to is None else 0)
    return "\r\n".join([*fields, f"Content-Length: {length}", "", ""]).encode() + http


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files, top = pafs.FileSystem.from_uri(folder)
    out, records, written, member = None, 0, 0, None
    name = f"part-{TaskContext.get().partitionId():06d}.warc.gz"
    own = f"{top}/_{uuid.uuid4().hex}"

    def put(data: bytes) -> None:
        nonlocal written
        out.write(data)
        written += len(data)

    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for i in range(batch.num_rows):
            page_id, url, digest, size, refers_to, chunk_no, chunk = (c[i].as_py() for c in columns)
            if out is None:
                files.create_dir(top, recursive=True)
                out = files.open_output_stream(own, compression=None)
            if chunk_no == 0:
                if member:
                    put(member.compress(b"\r\n\r\n") + member.flush())
                member = zlib.compressobj(4, wbits=31)
                records += 1
                put(member.compress(_heads(page_id, url, digest, size, refers_to)))
            if chunk:
                put(member.compress(chunk))
    if out is None:
        return
    put(member.compress(b"\r\n\r\n") + member.flush())
    out.close()
    try:
        files.move(own, f"{top}/{name}")
    except OSError:  # stores that do not rename onto an existing file
        files.delete_file(f"{top}/{name}")
        files.move(own, f"{top}/{name}")
    yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "n_records": [records], "n_bytes": [written]})


def read_warc(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records below ``folder`` as rows of chunks: number, bytes, and size and digest up to the chunk's end.

    A revisit has one row, with no bytes and the size and digest of the payload it refers to. A payload that
    does not match the digest of its record raises.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path")
    return found.mapInArrow(lambda batches: _read(batches, with_payload), CHUNKS)


def _read(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ("url", pa.string()), ("chunk_no", pa.int64()), ("chunk", pa.binary()), ("bytes_so_far", pa.int64()),
            ("digest_so_far", pa.string()), ("is_last", pa.bool_()),
        ]
    )
    rows: list[tuple] = []
    for batch in batches:
        for path in batch.column(0).to_pylist():
            if path.startswith("file:/") and not path.startswith("file://"):
                path = f"file://{path[5:]}"
            files, name = pafs.FileSystem.from_uri(path)
            with files.open_input_stream(name, compression=None) as raw, io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 16) as stream:
                for row in _records(stream, with_payload):
                    rows.append(row)
                    if len(rows) == READ_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _head(stream: io.BufferedReader) -> tuple[dict[str, str], int]:
    """Header lines up to the empty one, and how many bytes they took."""
    fields, taken = {}, 0
    while line := stream.readline():
        taken += len(line)
        if line == b"\r\n":
            break
        name, _, value = line.decode().partition(": ")
        fields[name.lower()] = value.rstrip("\r\n")
    return fields, taken


def _records(stream: io.BufferedReader, with_payload: bool) -> Iterator[tuple]:
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a WARC record: {line[:40]!r}")
        fields, _ = _head(stream)
        page_id = int(fields["x-page-id"]) if "x-page-id" in fields else None
        refers_to = int(fields["x-refers-to-page"]) if "x-refers-to-page" in fields else None
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        common = (page_id, fields["warc-record-id"], fields["warc-type"], refers_to, fields.get("warc-target-uri"))
        left = int(fields["content-length"])
        stream_head, taken = _head(stream)
        left -= taken
        if fields["warc-type"] == "revisit":
            yield *common, 0, None, int(fields["x-payload-length"]), digest, True
            continue
        running, so_far, number = hashlib.sha1(), 0, 0
        while True:
            chunk = stream.read(min(left, CHUNK_BYTES))
            if len(chunk) < min(left, CHUNK_BYTES):
                raise ValueError("a record ends before its content")
            left -= len(chunk)
            so_far += len(chunk)
            running.update(chunk)
            now = base64.b32encode(running.digest()).decode()
            if not left and now != digest:
                raise ValueError(f"{fields['warc-record-id']}: payload and digest differ")
            yield *common, number, chunk if with_payload else None, so_far, now, not left
            number += 1
            if not left:
                break


def payloads(chunks: DataFrame) -> DataFrame:
    """One row per record from its last chunk: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    return chunks.where("is_last").select(
        "page_id",
        F.col("bytes_so_far").alias("payload_bytes"),
        F.col("digest_so_far").alias("payload_digest"),
        "record_type",
        "refers_to",
        "record_id",
    )
