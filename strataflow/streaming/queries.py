"""Starting and awaiting streaming queries. Every query that keeps data has a checkpoint."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from strataflow.sources.catalog import create_table_like, is_streamed, write_batch
from strataflow.spec import TableFormat


def to_table(
    df: DataFrame,
    table: str,
    checkpoint: str,
    fmt: TableFormat = TableFormat(streamed=True),
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Append a stream to a streamed table, each row once, beside what batch jobs append to it.

    The table is created if it is not there; one that is not streamed is refused, since a batch that
    comes again could not replace itself there.
    """
    if not fmt.streamed:
        raise ValueError("a stream needs a streamed TableFormat")
    spark = df.sparkSession
    create_table_like(df, table, fmt)
    if not fmt.transactional and not is_streamed(spark, table):
        raise ValueError(f"{table} is not a streamed table: write it with TableFormat(streamed=True)")
    name = stream_id(checkpoint)
    work = lambda batch, batch_id: write_batch(batch, table, fmt, name, batch_id)
    return for_each_batch(df, work, checkpoint, available_now, every)


def for_each_batch(
    df: DataFrame,
    work: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Run ``work(batch, batch_id)`` per micro-batch. After a failure a batch comes again with the same id."""
    writer = df.writeStream.foreachBatch(work).outputMode("append").option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now, every).start()


def console(df: DataFrame, available_now: bool = False, every: str | None = None) -> StreamingQuery:
    """Print a stream, to look at it."""
    return _triggered(df.writeStream.format("console").outputMode("append"), available_now, every).start()


def await_any(spark: SparkSession, timeout: float | None = None) -> bool | None:
    """Wait until any query of the session ends or fails."""
    return spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()


def stream_id(checkpoint: str) -> str:
    """Name of the stream that belongs to a checkpoint: a new checkpoint counts its batches anew."""
    return hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def _triggered(writer: DataStreamWriter, available_now: bool, every: str | None) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer
