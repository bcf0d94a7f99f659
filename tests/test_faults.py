"""Cases in which rows, columns or matches could go missing without an error."""

from __future__ import annotations

import threading
import warnings
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import strataflow.queries as queries
from plan import plan
from strataflow.functions import decode_json
from strataflow.operators import LinearClassifier, accuracy, fit, fit_category_table, fit_logistic, sparse_features, transform
from strataflow.plans import gold_in_place
from strataflow.session import METHOD_LIMIT, short_methods
from strataflow.sources import append, export_csv, is_streamed, overwrite, read_csv, read_messages, read_table, scratch_path
from strataflow.sources import files
from strataflow.sources.catalog import STREAM_ID, compact, create_table, write_batch
from strataflow.spec import FeatureSpec, TableFormat
from strataflow.streaming import stream_id, to_table

STREAMED = TableFormat(streamed=True)


def stream_rows(spark, tmp_path, table, ids, checkpoint):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / f"{min(ids)}.json").write_text("".join(f'{{"id": "{i}"}}\n' for i in ids))
    rows = decode_json(read_messages(spark, "text", {}, str(tmp_path / "in")), ["id"])
    to_table(rows, table, checkpoint, available_now=True).awaitTermination(300)


@pytest.mark.parametrize("stream_first", [True, False])
def test_stream_beside_batch_writes(spark, database, tmp_path, stream_first):
    table, checkpoint = f"{database}.rows", scratch_path(spark, "checkpoint")
    batch = spark.range(100, 102).selectExpr("string(id) AS id")
    if stream_first:
        stream_rows(spark, tmp_path, table, [1, 2, 3], checkpoint)
        append(batch, table)
    else:
        overwrite(batch, table, STREAMED)
        stream_rows(spark, tmp_path, table, [1, 2, 3], checkpoint)
    assert sorted(r[0] for r in read_table(spark, table).collect()) == ["1", "100", "101", "2", "3"]
    stream_rows(spark, tmp_path, table, [7, 8], checkpoint)
    append(batch, table, STREAMED)
    assert read_table(spark, table).count() == 9
    again = spark.createDataFrame([("1",), ("2",), ("3",)], "id string")
    write_batch(again, table, STREAMED, stream_id(checkpoint), 0)
    assert read_table(spark, table).count() == 9
    compact(spark, table, stream_id(checkpoint), 1)
    assert sorted(r[0] for r in read_table(spark, table).collect()) == sorted(["1", "2", "3", "7", "8"] + ["100", "101"] * 2)
    assert spark.table(table).where(f"{STREAM_ID} <> 'batch'").select("strataflow_batch_id").distinct().count() == 1


def test_stream_refuses_a_table_that_cannot_take_batches(spark, database):
    overwrite(spark.range(3).selectExpr("string(id) AS id"), f"{database}.plain")
    rows = spark.readStream.format("rate").load().selectExpr("string(value) AS id")
    with pytest.raises(ValueError, match="not a streamed table"):
        to_table(rows, f"{database}.plain", scratch_path(spark, "checkpoint"))
    with pytest.raises(ValueError, match="streamed TableFormat"):
        to_table(rows, f"{database}.other", scratch_path(spark, "checkpoint"), TableFormat())


def test_columns_of_a_user_stay(spark, database):
    rows = spark.createDataFrame([(1, "s", 2)], "batch_id bigint, stream_id string, v int")
    for fmt in (TableFormat(), STREAMED):
        table = f"{database}.mine_{fmt.streamed}"
        overwrite(rows, table, fmt)
        assert [tuple(r) for r in read_table(spark, table).collect()] == [(1, "s", 2)]
        assert is_streamed(spark, table) == fmt.streamed
    with pytest.raises(ValueError, match="reserved"):
        overwrite(rows.withColumnRenamed("stream_id", STREAM_ID), f"{database}.other")
    with pytest.raises(ValueError, match="reserved"):
        create_table(spark, f"{database}.other", f"a int, {STREAM_ID} string")


TEXTS = [" pad ", "x,y\\", 'he said "hi", ok', "two\nlines", "carriage\r\nreturn", "", None, '"', '""', "\\", ",", "\t", "a\\\"b", "é 日本"]


@pytest.mark.parametrize("single_file", [True, False])
def test_csv_keeps_text(spark, single_file):
    rows = spark.createDataFrame([(i, t, 1.5) for i, t in enumerate(TEXTS)], "k int, t string, x double")
    path = scratch_path(spark, "csv")
    export_csv(rows, path, single_file)
    assert sorted(read_csv(spark, path, rows.schema).collect()) == sorted(rows.collect())
    loose = read_csv(spark, path)
    assert {r["k"]: r["t"] for r in loose.collect()} == {str(i): t for i, t in enumerate(TEXTS)}
    assert read_csv(spark, path).select("k").count() == len(TEXTS)


@pytest.mark.parametrize("record", ["1,a,9", "1"])
def test_records_of_another_width_raise(spark, tmp_path, record):
    (tmp_path / "x.csv").write_text(f"k,t\n2,b\n{record}\n")
    for schema in (None, "k int, t string"):
        with pytest.raises(Exception, match="(?i)malformed"):
            read_csv(spark, str(tmp_path / "x.csv"), schema).collect()


def test_missing_prediction_is_a_miss(spark):
    rows = spark.createDataFrame([(1, 1), (None, None), (None, 1), (0, None)], "label int, prediction int")
    assert accuracy(rows, "label", "prediction").first()["accuracy"] == 0.25


def test_scoring_reads_only_what_is_asked_for(spark, database):
    spec = FeatureSpec(("k",), ("c",), ("x",))
    path = scratch_path(spark, "raw")
    spark.createDataFrame([(1, "a", 1.0, "long"), (2, "b", 2.0, "text")], "k int, c string, x double, t string").write.parquet(path)
    rows = spark.read.parquet(path)
    model = LinearClassifier("y", ("c_a", "x"), (0, 1), ((1.0, 1.0),), (0.0,))
    scored = gold_in_place(rows, fit(rows, spec), model, spec)
    assert scored.columns == ["k", "c", "x", "t", "y"]
    text = plan(scored.select("k", "y"))
    assert "ReadSchema: struct<k:int,c:string,x:double>" in text.replace("\n", "")
    known = fit(rows.where("c = 'a'"), spec)
    with pytest.raises(Exception, match="unknown category"):
        gold_in_place(rows, known, model, spec).select("k", "y").collect()


def test_long_lists_of_categories_are_joined(spark):
    rows = spark.range(2000).selectExpr("id", "concat('c', id % 60) AS c", "CASE WHEN id > 5 THEN double(id) END AS x")
    spec = FeatureSpec(("id",), ("c",), ("x",))
    fitted = fit(rows, spec)
    found = transform(rows, fitted, ["id"])
    assert "BroadcastHashJoin" in plan(found)
    for row in found.where("id < 70").collect():
        assert [n for n in fitted.feature_names[:60] if row[n] == 1.0] == [f"c_c{row['id'] % 60}"]
    few = fit(rows.where("id % 60 < 50"), spec)
    with pytest.raises(Exception, match="unknown category in c: c5"):
        transform(rows, few, ["id"]).collect()
    zeros = transform(rows, few, ["id"], on_unknown="ignore").where("id = 55").first()
    assert not any(zeros[n] for n in few.feature_names[:50])


def test_category_table(spark, monkeypatch):
    rows = spark.range(500).selectExpr("id", "concat('n', id) AS n", "IF(id % 7 = 0, NULL, concat('b', id % 3)) AS b", "double(id) AS x")
    spec = FeatureSpec(("id",), ("n", "b"), ("x",))
    fitted = fit_category_table(rows, spec, scratch_path(spark, "categories"))
    names = sorted(f"n{i}" for i in range(500) if i % 7)
    assert fitted.sizes == (len(names), 3) and fitted.size == len(names) + 4
    expected = {}
    for i in range(500):
        if i % 7:
            entries = [(names.index(f"n{i}"), 1.0), (len(names) + i % 3, 1.0)]
            expected[i] = entries + ([(len(names) + 3, i / 499)] if i else [])
    for limit in (1_000_000, 10):
        monkeypatch.setattr("strataflow.operators.joins.BROADCAST_ROWS", limit)
        found = sparse_features(rows, fitted, ["id"]).collect()
        assert {r["id"]: list(zip(r["features"]["indices"], r["features"]["values"])) for r in found} == expected
        other = spark.createDataFrame([(1, "zzz", "b1", 0.0)], rows.schema)
        with pytest.raises(Exception, match="unknown category in n: zzz"):
            sparse_features(other, fitted, ["id"]).collect()
        (row,) = sparse_features(other, fitted, ["id"], on_unknown="ignore").collect()
        assert row["features"]["indices"] == [len(names) + 1]


def test_training_that_does_not_end_warns(spark):
    rows = spark.range(100).selectExpr("double(id) / 100 AS x", "double(id % 7) AS z", "int(id % 5 = 0 OR id > 70) AS y")
    with pytest.warns(UserWarning, match="no convergence in 1"):
        fit_logistic(rows, "y", ["x", "z"], max_iter=1)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert fit_logistic(rows, "y", ["x", "z"]).iterations > 1
    with pytest.raises(ValueError, match="more than 1 values"):
        fit_logistic(rows, "y", ["x"], max_classes=1)


def test_scratch_needs_a_folder(monkeypatch):
    monkeypatch.setattr(files, "_own_folder", [])
    bare = SimpleNamespace(conf={})
    with pytest.raises(ValueError, match="set spark.checkpoint.dir"):
        scratch_path(bare, "x")
    files.use_scratch("/own/")
    assert scratch_path(bare, "x").startswith("/own/strataflow/x-")
    shared = SimpleNamespace(conf={"spark.checkpoint.dir": "hdfs://shared"})
    assert scratch_path(shared, "x").startswith("hdfs://shared/strataflow/x-")


def test_threads_share_the_setting(spark):
    before = spark.conf.get(METHOD_LIMIT)
    entered, leave = threading.Event(), threading.Event()

    def work():
        with short_methods(spark):
            entered.set()
            leave.wait(30)

    thread = threading.Thread(target=work)
    with short_methods(spark):
        thread.start()
        entered.wait(30)
    assert spark.conf.get(METHOD_LIMIT) == "8000"
    leave.set()
    thread.join()
    assert spark.conf.get(METHOD_LIMIT) == before


@pytest.mark.parametrize("name", ["label_join_frequent", "gold_join_frequent"])
def test_frequent_joins_are_salted(spark, name):
    text = plan(getattr(queries, name)(spark, "/root/testdata/sf0.001"))
    assert "__salt" in text and text.count("SortMergeJoin") == 1 and "Broadcast" not in text


def test_bad_number_does_not_stop_the_layers(spark, tmp_path):
    stream = queries._layer_stream(spark, "/root/testdata/sf0.001")
    (tmp_path / "in").mkdir()
    lines = ['{"event_id": "1", "event_type": "view", "value": "abc"}', '{"event_id": "2", "event_type": "view", "value": "1.5"}']
    (tmp_path / "in" / "1.json").write_text("\n".join(lines) + "\n")
    query = stream.start(read_messages(spark, "text", {}, str(tmp_path / "in")), scratch_path(spark, "checkpoint"), available_now=True)
    assert query.awaitTermination(300)
    counts = {layer: read_table(spark, stream.layers.table(layer)).count() for layer in ("bronze", "silver", "gold")}
    assert counts == {"bronze": 2, "silver": 2, "gold": 1}
    assert read_table(spark, stream.layers.table("silver")).where(F.col("value").isNull()).count() == 1
