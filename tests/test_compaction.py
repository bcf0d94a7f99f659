"""Compaction that is stopped at any of its statements, and run again."""

from __future__ import annotations

import pytest

from strataflow.sources import create_table, read_table
from strataflow.sources.catalog import compact, write_batch
from strataflow.spec import TableFormat

FORMAT = TableFormat("parquet", streamed=True)


class Stopping:
    """A session that fails instead of running one of its statements."""

    def __init__(self, spark, after):
        self._spark, self._left = spark, after

    def __getattr__(self, name):
        return getattr(self._spark, name)

    def sql(self, text):
        if self._left == 0:
            raise KeyboardInterrupt
        self._left -= 1
        return self._spark.sql(text)


@pytest.mark.parametrize("after", range(7))
def test_rows_never_change(spark, database, after):
    name = f"{database}.stopped_{after}"
    create_table(spark, name, "a BIGINT, b STRING", FORMAT)
    for batch in range(3):
        write_batch(spark.range(10).selectExpr(f"id + {batch * 10} AS a", "'x' AS b"), name, FORMAT, "one'stream", batch)
    write_batch(spark.range(100, 105).selectExpr("id AS a", "'y' AS b"), name, FORMAT, "other", 0)
    expected = sorted(map(tuple, read_table(spark, name).collect()))
    stopped = False
    try:
        compact(Stopping(spark, after), name, "one'stream", 2)
    except KeyboardInterrupt:
        stopped = True
    assert stopped == (after < 6)
    for _ in range(2):
        compact(spark, name, "one'stream", 2)
        assert sorted(map(tuple, read_table(spark, name).collect())) == expected
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2
    assert not spark.catalog.tableExists(f"{name}_compacting")
