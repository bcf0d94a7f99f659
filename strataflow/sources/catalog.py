"""Databases, tables and views of the session catalog, in any table format Spark has."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions.columns import quoted
from strataflow.spec import TableFormat

STREAM_ID, BATCH_ID = "strataflow_stream_id", "strataflow_batch_id"
BATCH_COLUMNS = (STREAM_ID, BATCH_ID)
"""Partition columns of streamed tables. The names are reserved: frames that have them are refused."""

NOT_STREAMED = ("batch", 0)
"""Values of the batch columns for rows that a batch job wrote."""


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{_text(location)}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def schema_ddl(schema: T.StructType) -> str:
    """The schema as a column list for ``CREATE TABLE``, for every type, all columns nullable."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema]).toDDL()


def create_table(spark: SparkSession, name: str, columns: str | T.StructType, fmt: TableFormat = TableFormat()) -> None:
    """``CREATE TABLE IF NOT EXISTS`` from a column list such as ``"a STRING, b BIGINT"``, or a schema."""
    ddl = schema_ddl(columns) if isinstance(columns, T.StructType) else columns
    _check_reserved(columns.names if isinstance(columns, T.StructType) else T.StructType.fromDDL(columns).names)
    tail = ""
    if fmt.batch_partitions:
        ddl += f", {STREAM_ID} STRING, {BATCH_ID} BIGINT"
        tail = f" PARTITIONED BY ({STREAM_ID}, {BATCH_ID})"
    if fmt.options:
        tail += " OPTIONS (" + ", ".join(f"'{_text(k)}' '{_text(str(v))}'" for k, v in fmt.options.items()) + ")"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING {fmt.name}{tail}")


def create_table_like(df: DataFrame, name: str, fmt: TableFormat = TableFormat()) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with the columns of a frame."""
    create_table(df.sparkSession, name, df.schema, fmt)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table; of a streamed one without the two columns that only mark micro-batches."""
    rows = spark.table(name)
    return rows.drop(*BATCH_COLUMNS) if is_streamed(spark, name) else rows


def is_streamed(spark: SparkSession, name: str) -> bool:
    """Whether a table is partitioned by the columns that mark micro-batches."""
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    return partitions == list(BATCH_COLUMNS)


def overwrite(df: DataFrame, name: str, fmt: TableFormat = TableFormat()) -> None:
    """Replace a managed table and its schema by the frame, which must not read that table.

    Parquet has no transactions: a reader may see the table missing while it is replaced.
    """
    writer = _marked(df, fmt).write.format(fmt.name).mode("overwrite").options(**fmt.options)
    if fmt.transactional:
        writer = writer.option("overwriteSchema", "true")
    if fmt.batch_partitions:
        writer = writer.partitionBy(*BATCH_COLUMNS)
    writer.saveAsTable(name)


def append(df: DataFrame, name: str, fmt: TableFormat = TableFormat()) -> None:
    """Add rows to a table, columns matched by name. A streamed table is known by its partitions, whatever ``fmt`` says."""
    spark = df.sparkSession
    if not fmt.batch_partitions and spark.catalog.tableExists(name) and is_streamed(spark, name):
        fmt = replace(fmt, streamed=True)
    writer = _marked(df, fmt).write.format(fmt.name).mode("append").options(**fmt.options)
    if fmt.batch_partitions:
        writer = writer.partitionBy(*BATCH_COLUMNS)
    writer.saveAsTable(name)


def write_batch(df: DataFrame, name: str, fmt: TableFormat, stream_id: str, batch_id: int) -> None:
    """Add a micro-batch to a streamed table so that writing it again changes nothing.

    A transactional format remembers the batches it has seen. Others replace the partition
    of this batch, which leaves all other batches alone.
    """
    if fmt.transactional:
        writer = df.write.format(fmt.name).mode("append").options(**fmt.options)
        writer.option("txnAppId", f"{stream_id}.{name}").option("txnVersion", batch_id).saveAsTable(name)
        return
    spark = df.sparkSession
    if not is_streamed(spark, name):
        raise ValueError(f"{name} is not a streamed table: create it with TableFormat(streamed=True)")
    columns = [c for c in spark.table(name).columns if c not in BATCH_COLUMNS]
    if sorted(columns) != sorted(df.columns):
        raise ValueError(f"{name} has the columns {columns}, the batch has {df.columns}")
    view = f"batch_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {name} "
            f"PARTITION ({STREAM_ID} = '{_text(stream_id)}', {BATCH_ID} = {int(batch_id)}) "
            f"SELECT {', '.join(map(quoted, columns))} FROM {view}"
        )
    finally:
        spark.catalog.dropTempView(view)


def compact(spark: SparkSession, name: str, stream_id: str, through: int) -> None:
    """Merge the batches of a stream up to ``through``, which must be closed, into the partition of that batch.

    A stream that writes a partition per batch has ever more of them; run this from time to time for batches that
    its checkpoint has committed, while nothing reads the table. The merged rows are staged in a table ``{name}_compacting`` whose
    rename is the commit; a run that finds it finishes what an interrupted one began, from the staged rows alone.
    """
    if not is_streamed(spark, name):
        raise ValueError(f"{name} is not a streamed table")
    staged = f"{name}_compacting"
    _finish_compaction(spark, name, staged)
    mine = f"{STREAM_ID} = '{_text(stream_id)}'"
    old = spark.table(name).where(f"{mine} and {BATCH_ID} <= {int(through)}")
    numbers = sorted(r[0] for r in old.select(BATCH_ID).distinct().collect())
    if len(numbers) < 2:
        return
    columns = ", ".join(quoted(c) for c in spark.table(name).columns if c not in BATCH_COLUMNS)
    merged = f"{name}_merged_{uuid.uuid4().hex}"
    about = f"'stream' = '{_text(stream_id)}', 'batches' = '{','.join(map(str, numbers))}'"
    spark.sql(
        f"CREATE TABLE {merged} USING parquet TBLPROPERTIES ({about}) "
        f"AS SELECT {columns} FROM {name} WHERE {mine} AND {BATCH_ID} <= {int(through)}"
    )
    spark.sql(f"ALTER TABLE {merged} RENAME TO {staged}")
    _finish_compaction(spark, name, staged)


def _finish_compaction(spark: SparkSession, name: str, staged: str) -> None:
    """Replace the batches of a staged compaction by its rows, if there is one; doing so again changes nothing."""
    if not spark.catalog.tableExists(staged):
        return
    about = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {staged}").collect()}
    numbers = [int(n) for n in about["batches"].split(",")]
    mine = f"{STREAM_ID} = '{_text(about['stream'])}'"
    columns = ", ".join(quoted(c) for c in spark.table(staged).columns)
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({mine}, {BATCH_ID} = {numbers[-1]}) SELECT {columns} FROM {staged}")
    gone = ", ".join(f"PARTITION ({mine}, {BATCH_ID} = {number})" for number in numbers[:-1])
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {gone}")
    spark.sql(f"DROP TABLE {staged}")


def publish(df: DataFrame, name: str) -> str:
    """Make the frame a view for all sessions of the application; returns its name for SQL."""
    df.createOrReplaceGlobalTempView(name)
    return f"global_temp.{name}"


def _check_reserved(names: Iterable[str]) -> None:
    taken = [n for n in names if n.lower() in BATCH_COLUMNS]
    if taken:
        raise ValueError(f"these column names are reserved: {taken}")


def _marked(df: DataFrame, fmt: TableFormat) -> DataFrame:
    _check_reserved(df.columns)
    if not fmt.batch_partitions:
        return df
    stream_id, batch_id = NOT_STREAMED
    return df.withColumns({STREAM_ID: F.lit(stream_id), BATCH_ID: F.lit(batch_id).cast("bigint")})


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")
