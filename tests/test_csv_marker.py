"""No text is taken for the marker of empty ones."""

from __future__ import annotations

from strataflow.sources import export_csv, read_csv, scratch_path


def test_control_characters_come_back(spark):
    texts = ["\x02", "\x02\x02", "", None, "\x01", "empty-", " ", '"', "a\nb"]
    rows = [(i, t) for i, t in enumerate(texts)]
    path = scratch_path(spark, "csv")
    export_csv(spark.createDataFrame(rows, "i bigint, t string"), path)
    found = read_csv(spark, path, "i bigint, t string")
    assert sorted(tuple(r) for r in found.collect()) == rows
