"""CSV in and out, and where temporary tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions.columns import column
from strataflow.sources.ranges import csv_records

DIALECT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
"""Shared by reader and writer: quotes inside a field are doubled, blanks are kept, backslashes mean nothing."""

FILE_OPTIONS = {"pathGlobFilter", "recursiveFileLookup", "modifiedBefore", "modifiedAfter"}
SPLIT_OPTIONS = FILE_OPTIONS | {"sep", "nullValue", "dateFormat", "timestampFormat", "timestampNTZFormat", "locale"}
"""Options that hold for files that are cut, besides the dialect above."""


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    infer: bool = False,
    multi_line: bool | str = True,
    **options: str | bool,
) -> DataFrame:
    """CSV with a header. All columns are text unless a schema is given or ``infer`` is set.

    The columns of a schema must be those of the header, in order; other headers raise, and so do records
    with more or fewer fields. An unquoted empty field is null, ``""`` is an empty text.
    ``infer`` reads the files twice; a schema reads them once. With ``multi_line=True`` a file is one task, since fields may
    hold line breaks. ``multi_line="split"`` cuts large files into tasks all the same (see ``ranges.csv_records``): the
    same rows, or an error where a quote stands in an unquoted field. ``multi_line=False`` cuts them at every line break.
    """
    # what the reader puts for an empty text between quotes, so that it is not taken for a missing one: a new name each
    # time, so that no file can hold it
    empty = f"empty-{uuid.uuid4().hex}"
    strict = {"enforceSchema": False, "mode": "FAILFAST", "columnPruning": False, "emptyValue": empty}
    reader = spark.read.options(**{**DIALECT, **strict, "multiLine": bool(multi_line), **options})
    if multi_line == "split":
        if infer or (unknown := set(options) - SPLIT_OPTIONS):
            raise ValueError("infer needs multi_line=True" if infer else f"options that need multi_line=True: {sorted(unknown)}")
        # without a schema the reader looks at the first header only
        wanted = reader.csv(path).schema if schema is None else spark.createDataFrame([], schema).schema
        files = {c: v for c, v in options.items() if c in FILE_OPTIONS}
        fields = {c: v for c, v in options.items() if c not in FILE_OPTIONS}
        records = csv_records(spark, path, wanted.names, str(options.get("sep", ",")), **files)
        parse = {**DIALECT, "header": False, "mode": "FAILFAST", "emptyValue": empty, "multiLine": True, **fields}
        parse = {c: str(v).lower() if isinstance(v, bool) else v for c, v in parse.items()}
        # all fields are read, so that a record with more or fewer raises
        rows = records.select(F.from_csv("record", F.lit(wanted.toDDL()), parse).alias("row")).select("row.*")
    elif schema is not None:
        rows = reader.schema(schema).csv(path)
    else:
        rows = reader.option("inferSchema", infer).csv(path)
    texts = {f.name for f in rows.schema if isinstance(f.dataType, T.StringType)}
    shown = [
        F.when(column(c) == empty, "").otherwise(column(c)).alias(c) if c in texts else column(c) for c in rows.columns
    ]
    return rows.select(shown)


def export_csv(
    df: DataFrame, path: str, single_file: bool = False, mode: str = "errorifexists", **options: str | bool
) -> None:
    """Write CSV with a header under ``path``, one file per task or a single one for small results.

    :func:`read_csv` reads it back as it was, given the schema: blanks, quotes, backslashes, line
    breaks, empty and missing text.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).options(**{**DIALECT, "emptyValue": '""', **options}).csv(path)


_own_folder: list[str] = []


def use_scratch(folder: str) -> None:
    """Where :func:`scratch_path` goes in sessions that name no shared folder, as on a laptop or in tests."""
    _own_folder[:] = [folder]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, or below what :func:`use_scratch` named where that is not set."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or next(iter(_own_folder), None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{shared.rstrip('/')}/strataflow/{name}-{uuid.uuid4().hex}"
