"""Rows to JSON messages and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.columns import column

MALFORMED, MESSAGE = "strataflow_malformed", "strataflow_message"
"""Columns beside decoded fields, which must have other names."""


def decode_json(df: DataFrame, fields: Sequence[str], value: str = "value") -> DataFrame:
    """Top-level fields of the JSON object in ``value`` (text or bytes), all as strings.

    A missing key, a JSON null and text that is no JSON give null. The text is parsed once
    for all fields.
    """
    text = column(value).cast("string")
    return df.select(F.json_tuple(text, *fields).alias(*fields))


def is_malformed(value: str = "value") -> Column:
    """Whether a message is no JSON object: broken JSON, a list or a plain value, empty, or null."""
    return F.json_object_keys(column(value).cast("string")).isNull()


def decode_or_keep(df: DataFrame, fields: Sequence[str], value: str = "value") -> DataFrame:
    """The fields as by :func:`decode_json`, then ``MALFORMED`` and, of malformed messages, their text as ``MESSAGE``."""
    text = column(value).cast("string")
    bad = is_malformed(value)
    return df.select(F.json_tuple(text, *fields).alias(*fields), bad.alias(MALFORMED), F.when(bad, text).alias(MESSAGE))


def encode_json(df: DataFrame, columns: Sequence[str] | None = None, value: str = "value") -> DataFrame:
    """One JSON object per row; every message has every field, null included."""
    fields = F.struct(*[column(c) for c in columns or df.columns])
    return df.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias(value))
