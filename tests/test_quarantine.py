"""Messages that are no JSON objects, in a stream into the layers."""

from __future__ import annotations

import json

import pytest

from strataflow.functions.messages import is_malformed
from strataflow.operators import LinearClassifier, Preparation
from strataflow.sources import read_messages, read_table, scratch_path
from strataflow.spec import FeatureSpec, Layers, TableFormat
from strataflow.streaming import LayerStream

GOOD = ['{"id": "1", "kind": "a", "x": 3}', '{"id": "2"}', "{}", '{"id": "4", "more": [1, {"k": 2}], "x": "5"}', ' {"id": null}']
BAD = ['{"id": "1"', "", "no json", '["id"]', '"id"', "7", "null", '{"id" "1"}']


def test_what_is_malformed(spark):
    rows = spark.createDataFrame([(t,) for t in [*GOOD, *BAD, None]], "value string")
    found = [r["value"] for r in rows.where(is_malformed()).collect()]
    assert found == [*BAD, None]
    as_bytes = rows.selectExpr("cast(value AS binary) AS value")
    assert as_bytes.where(is_malformed()).count() == len(BAD) + 1


@pytest.mark.parametrize("quarantine", [None, "quarantine"])
def test_stream_with_malformed_messages(spark, database, quarantine):
    spec = FeatureSpec(("id",), ("kind",), ("x",), label="y")
    prepared = Preparation({"kind": ("a", "b")}, {"x": (0.0, 10.0)})
    model = LinearClassifier("y", tuple(prepared.feature_names), (0, 1), ((1.0, 0.0, 1.0),), (0.0,))
    layers = Layers(database, fmt=TableFormat(streamed=True))
    stream = LayerStream(("id", "kind", "x"), spec, layers, prepared, model, quarantine=quarantine)
    path, checkpoint = scratch_path(spark, "messages"), scratch_path(spark, "checkpoint")
    texts = [t for t in [*GOOD, *BAD] if t]
    spark.createDataFrame([(t,) for t in texts], "value string").repartition(3).write.text(path)
    query = stream.start(read_messages(spark, "text", {"maxFilesPerTrigger": "1"}, path), checkpoint, available_now=True)
    assert query.awaitTermination(120)
    bronze = read_table(spark, layers.table("bronze"))
    if quarantine is None:
        assert bronze.count() == len(texts)
        return
    metrics = [p["observedMetrics"]["messages"] for p in map(_as_dict, query.recentProgress) if p["observedMetrics"]]
    assert sum(m["messages"] for m in metrics) == len(texts)
    assert sum(m["malformed"] for m in metrics) == len(BAD) - 1
    assert bronze.count() == len(GOOD)
    kept = read_table(spark, stream.quarantine_table)
    assert sorted(r["message"] for r in kept.collect()) == sorted(t for t in BAD if t)
    stream.compact(spark, checkpoint, 2)
    assert spark.sql(f"SHOW PARTITIONS {stream.quarantine_table}").count() == 1
    kept = read_table(spark, stream.quarantine_table)
    assert sorted(r["message"] for r in kept.collect()) == sorted(t for t in BAD if t)


def _as_dict(progress):
    return json.loads(progress.json)
