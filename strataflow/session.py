"""A session setting for wide tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
COMPILED_BYTES = 8000
"""Bytes of a method from which the JVM no longer compiles it."""

_lock = Lock()
_open: dict[int, tuple[int, str]] = {}
"""Uses of the setting per session, and its value before the first."""


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Let Spark split generated code that the JVM would otherwise interpret.

    A projection of some sixty to a hundred columns becomes one method that is too long for
    the JVM's compiler and runs about ten times slower than it could. The jobs and the
    layer stream run under this setting; use it around actions on wide frames of your own. Threads
    that share a session share the setting, until the last of them is done.
    """
    session = id(spark._jsparkSession)
    with _lock:
        users, before = _open.get(session, (0, spark.conf.get(METHOD_LIMIT)))
        _open[session] = users + 1, before
        spark.conf.set(METHOD_LIMIT, str(min(int(before), COMPILED_BYTES)))
    try:
        yield
    finally:
        with _lock:
            users, before = _open.pop(session)
            if users > 1:
                _open[session] = users - 1, before
            else:
                spark.conf.set(METHOD_LIMIT, before)
