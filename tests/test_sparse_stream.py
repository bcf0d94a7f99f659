"""Streams whose categories stay a table: odd rows, a version that changes, batches that come again."""

from __future__ import annotations

import pytest

from strataflow import FeatureSpec, Layers, TableFormat
from strataflow.operators import fit_category_table, fit_table_logistic, sparse_features
from strataflow.sources import read_table, scratch_path
from strataflow.streaming import SparseLayerStream

FIELDS = ("id", "kind", "size")
SPEC = FeatureSpec(("id",), ("kind",), ("size",))


def state(spark, kinds):
    rows = spark.createDataFrame([(str(i), k, float(i % 5), i % 2) for i, k in enumerate(kinds * 4)], "id string, kind string, size double, large int")
    fitted = fit_category_table(rows, SPEC, scratch_path(spark, "categories"))
    return fitted, fit_table_logistic(sparse_features(rows, fitted, ["large"]), "large", fitted, scratch_path(spark, "fit"), tol=0.01)


def test_versions_odd_rows_and_batches_that_come_again(spark, database):
    stream = SparseLayerStream(FIELDS, SPEC, Layers(database, fmt=TableFormat(streamed=True)), {0: state(spark, ["a", "b", "d"]), 2: state(spark, ["a", "b", "c", "d"])})
    stream.create_tables(spark)
    rows = [("1", "a", "2.0"), ("2", "c", "4"), ("3", None, "0"), ("4", "d", None), ("5", "d", "no"), (None, "d", "1"), ("1", "a", "2.0")]
    text = ", ".join(f"{f} string" for f in FIELDS)
    for batch_id in (0, 2, 1, 1, 0):
        stream.write(spark.createDataFrame(rows, text), batch_id, "s")
    stream.write(spark.createDataFrame([], text), 3, "s")
    bronze, silver, gold = (read_table(spark, stream.layers.table(layer)) for layer in ("bronze", "silver", "gold"))
    assert (bronze.count(), silver.count(), gold.count()) == (21, 21, 12)
    found = {(r["fitted_since"], r["id"]): r["features"] and r["features"]["indices"] for r in silver.collect()}
    assert found[0, "1"] == [0, 3] and found[2, "1"] == [0, 4]
    assert found[0, "2"] == [3] and found[2, "2"] == [2, 4]
    assert found[0, "3"] == [] and found[0, "4"] is found[0, "5"] is None and found[0, None] == [2, 3] and found[2, None] == [3, 4]
    assert sorted({r["id"] for r in gold.collect()}) == ["1", "2", "3"]
    assert {r["large"] for r in gold.collect()} <= {0, 1}


def test_no_version_for_the_first_batches(spark, database):
    stream = SparseLayerStream(FIELDS, SPEC, Layers(database, fmt=TableFormat(streamed=True)), {1: state(spark, ["a", "b"])})
    with pytest.raises(ValueError, match="batch 0"):
        stream.version(0)
