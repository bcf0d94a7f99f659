"""Column expressions and small frame helpers without state."""

from strataflow.functions.columns import (
    all_present,
    column,
    complete_rows,
    feature_name,
    number,
    quoted,
    sanitize_names,
)
from strataflow.functions.messages import decode_json, encode_json

__all__ = [
    "all_present",
    "column",
    "complete_rows",
    "decode_json",
    "encode_json",
    "feature_name",
    "number",
    "quoted",
    "sanitize_names",
]
