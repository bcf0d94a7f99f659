"""The batch jobs from CSV to gold, and streams against them."""

from __future__ import annotations

import csv
import json
import os
import random

import pytest

from plan import plan
from strataflow.functions import decode_json
from strataflow.operators import LinearClassifier, Registry, fit, load_preparation
from strataflow.plans import build_features, export_training_set, ingest_csv, save_training_set, score_by_join, score_in_place, train
from strataflow.plans import feature_rows, gold_by_join, gold_in_place
from strataflow.session import METHOD_LIMIT, short_methods
from strataflow.sources import overwrite, read_csv, read_messages, read_table, scratch_path
from strataflow.spec import FeatureSpec, Layers, TableFormat
from strataflow.streaming import LayerStream, await_any, console, stream_id, to_table

FIELDS = ["Id", "Class", "Name", "Age", "Deck", "Fare"]
SPEC = FeatureSpec(("Id", "Name"), ("Class", "Deck"), ("Age", "Fare"), "Survived")
SECONDS = 120


def people(n=60):
    """Rows with gaps in either feature group; every fifth has no deck, every seventh no age."""
    return [
        [
            str(i),
            str(i % 3 + 1),
            f"Doe, Mx. {i}",
            "" if i % 7 == 0 else str(10 + i % 40),
            "" if i % 5 == 0 else ["A1", "B2 C3"][i % 2],
            str(i * 1.25),
        ]
        for i in range(1, n + 1)
    ]


def write_csv(path, header, rows):
    os.makedirs(path)
    with open(f"{path}/part.csv", "w", newline="") as file:
        csv.writer(file).writerows([header, *rows])
    return path


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def layers_of(database, streamed=False):
    return Layers(database, fmt=TableFormat(streamed=streamed))


@pytest.mark.parametrize("streamed", [False, True])
def test_csv_to_gold(spark, database, tmp_path, streamed):
    layers = layers_of(database, streamed)
    raw = write_csv(tmp_path / "raw", FIELDS, people())
    labels = write_csv(tmp_path / "labels", ["Id", "Survived", "More"], [[str(i), str(i // 2 % 2), "x"] for i in range(1, 61)])
    ingest_csv(spark, str(raw), layers, FIELDS if streamed else None)
    bronze = read_table(spark, layers.table("bronze"))
    assert bronze.columns == FIELDS and bronze.count() == 60
    assert {f.dataType.simpleString() for f in bronze.schema} == {"string"}
    assert bronze.filter("Age IS NULL").count() == 8 and bronze.filter("Deck IS NULL").count() == 12

    saved = scratch_path(spark, "preparation")
    preparation = build_features(spark, layers, SPEC, saved)
    assert load_preparation(spark, saved, SPEC) == preparation
    silver = read_table(spark, layers.table("silver"))
    assert silver.columns == ["Id", "Name", "Class_1", "Class_2", "Class_3", "Deck_A1", "Deck_B2_C3", "Age", "Fare"]
    whole = [r[0] for r in people() if r[3] and r[4]]
    assert sorted(r["Id"] for r in silver.dropna().collect()) == sorted(whole)

    out = scratch_path(spark, "training")
    export_training_set(spark, layers, str(labels), SPEC, preparation, "Id", out, single_file=True)
    training = read_csv(spark, out, infer=True)
    assert training.columns == [*silver.columns, "Survived"] and training.count() == 60

    typed = read_csv(spark, str(labels)).selectExpr("Id", "int(Survived) AS Survived")
    save_training_set(spark, layers, typed, SPEC, preparation, "Id", f"{database}.training")
    stored = read_table(spark, f"{database}.training")
    assert stored.columns == training.columns
    assert values(stored.selectExpr("int(Id) AS Id", *stored.columns[1:])) == values(training)

    registry = Registry(database, scratch_path(spark, "models"))
    done = train(spark, training, SPEC, registry, "survival", "trial")
    assert done.version == 1 and 0 <= done.accuracy <= 1

    save_training_set(spark, layers, typed, SPEC, preparation, "Id", f"{database}.vectors", vectors=True)
    rows = read_table(spark, f"{database}.vectors")
    assert rows.columns == ["Id", "Name", "Survived", "features"] and rows.count() == stored.dropna().count()
    with pytest.raises(ValueError, match="names"):
        train(spark, rows, SPEC, registry, "survival", vector="features")
    again = train(
        spark, rows, SPEC, registry, "survival", features=preparation.feature_names, vector="features"
    )
    assert again.version == 2 and again.accuracy == done.accuracy
    assert again.model.weights[0] == pytest.approx(done.model.weights[0], abs=1e-5)

    score_by_join(spark, layers, SPEC, registry, "survival")
    gold = read_table(spark, layers.table("gold"))
    assert gold.columns == [*FIELDS, "Survived"]
    assert gold.schema["Survived"].dataType.simpleString() == "bigint"
    assert sorted(r["Id"] for r in gold.collect()) == sorted(whole)
    joined = values(gold)
    score_in_place(spark, layers, SPEC, preparation, registry, "survival")
    assert values(read_table(spark, layers.table("gold"))) == joined


def test_duplicate_keys_multiply_in_the_join_only(spark, database):
    layers = layers_of(database)
    rows = [tuple(v or None for v in r) for r in people(10)]
    overwrite(spark.createDataFrame([*rows, rows[0]], ", ".join(f"{c} string" for c in FIELDS)), layers.table("bronze"))
    preparation = build_features(spark, layers, SPEC)
    model = LinearClassifier("Survived", ("Age",), (0, 1), ((1.0,),), (-0.5,))
    registry = Registry(database, scratch_path(spark, "models"))
    registry.create(spark)
    registry.register(spark, model, "m")
    score_by_join(spark, layers, SPEC, registry, "m")
    assert spark.table(layers.table("gold")).filter("Id = '1'").count() == 4
    score_in_place(spark, layers, SPEC, preparation, registry, "m")
    assert spark.table(layers.table("gold")).filter("Id = '1'").count() == 2


def test_setting_for_wide_rows_is_put_back(spark):
    before = spark.conf.get(METHOD_LIMIT)
    with pytest.raises(RuntimeError), short_methods(spark):
        assert spark.conf.get(METHOD_LIMIT) == "8000"
        raise RuntimeError
    assert spark.conf.get(METHOD_LIMIT) == before != "8000"


def test_scoring_in_place_builds_no_features(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    spec = FeatureSpec(("o_orderkey",), ("o_orderpriority", "o_orderstatus"), ("o_totalprice",))
    fitted = fit(orders, spec)
    draw = random.Random(2)
    weights = tuple(tuple(draw.uniform(-1, 1) for _ in fitted.feature_names) for _ in range(3))
    model = LinearClassifier("y", tuple(fitted.feature_names), (1, 2, 3), weights, (0.1, 0.0, -0.1))
    found = gold_in_place(orders, fitted, model, spec)
    text = plan(found)
    assert "Exchange" not in text and "o_orderpriority_1-URGENT" not in text
    assert "IsNotNull(o_orderpriority)" in text and "IsNotNull(o_totalprice)" in text
    expected = gold_by_join(orders, feature_rows(orders, fitted, spec), model, spec)
    assert values(found) == values(expected) and found.select("y").distinct().count() > 1


# streams

MODEL = LinearClassifier("Survived", ("Class_1", "Deck_A1", "Age", "Fare"), (0, 1), ((0.5, -0.25, 1.0, 0.75),), (-0.5,))


@pytest.fixture
def fitted(spark, tmp_path, database):
    layers = layers_of(f"{database}_fit")
    ingest_csv(spark, str(write_csv(tmp_path / "fit", FIELDS, people())), layers)
    return build_features(spark, layers, SPEC)


def message(row, **changes):
    record = dict(zip(FIELDS, row)) | changes
    number = {"Id": int, "Class": int, "Age": float, "Fare": float}
    return json.dumps({k: number[k](v) if k in number and v not in ("", None) else v or None for k, v in record.items()})


def send(folder, name, lines):
    folder.mkdir(exist_ok=True)
    hidden = folder / f".{name}"
    hidden.write_text("\n".join(lines) + "\n")
    hidden.rename(folder / name)


def run(spark, stream, folder, checkpoint):
    messages = read_messages(spark, "text", {"maxFilesPerTrigger": "1"}, str(folder))
    query = stream.start(messages, checkpoint, available_now=True)
    assert query.awaitTermination(SECONDS)


def tables(spark, layers):
    return {layer: values(read_table(spark, layers.table(layer))) for layer in ("bronze", "silver", "gold")}


@pytest.fixture
def stream(database, fitted):
    return LayerStream(FIELDS, SPEC, layers_of(database, True), fitted, MODEL)


def test_stream_in_two_runs_equals_one(spark, tmp_path, stream):
    folder, checkpoint = tmp_path / "in", scratch_path(spark, "checkpoint")
    lines = [message(r) for r in people(20)]
    send(folder, "1.json", lines[:12])
    run(spark, stream, folder, checkpoint)
    send(folder, "2.json", lines[12:])
    run(spark, stream, folder, checkpoint)
    found = tables(spark, stream.layers)
    assert (len(found["bronze"]), len(found["silver"])) == (20, 20)
    run(spark, stream, folder, checkpoint)
    assert tables(spark, stream.layers) == found

    other = LayerStream(FIELDS, SPEC, layers_of(stream.layers.database + "_b", True), stream.preparation, MODEL)
    whole = tmp_path / "whole"
    send(whole, "all.json", lines)
    run(spark, other, whole, scratch_path(spark, "checkpoint"))
    assert tables(spark, other.layers) == found


def test_replayed_batch_changes_nothing(spark, tmp_path, stream):
    folder, checkpoint = tmp_path / "in", scratch_path(spark, "checkpoint")
    lines = [message(r) for r in people(10)]
    send(folder, "1.json", lines)
    run(spark, stream, folder, checkpoint)
    found = tables(spark, stream.layers)
    batch = decode_json(spark.createDataFrame([(line,) for line in lines], "value string"), FIELDS)
    stream.write(batch, 0, stream_id(checkpoint))
    assert tables(spark, stream.layers) == found
    stream.write(batch, 1, stream_id(checkpoint))
    assert len(tables(spark, stream.layers)["gold"]) == 2 * len(found["gold"])


def test_stream_agrees_with_python(spark, tmp_path, stream):
    folder = tmp_path / "in"
    rows = people(30)
    send(folder, "1.json", [message(r) for r in rows])
    run(spark, stream, folder, scratch_path(spark, "checkpoint"))
    (low, high), (least, most) = stream.preparation.ranges["Age"], stream.preparation.ranges["Fare"]
    expected = {}
    for key, group, _, age, deck, fare in rows:
        if age:
            margin = (-0.5 + 0.5 * (group == "1")) + (-0.25 * (deck == "A1") + (float(age) - low) / (high - low))
            expected[key] = int(margin + 0.75 * (float(fare) - least) / (most - least) > 0)
    gold = read_table(spark, stream.layers.table("gold"))
    assert {r["Id"]: r["Survived"] for r in gold.collect()} == expected
    assert len(set(expected.values())) == 2


def test_odd_messages(spark, tmp_path, stream):
    folder = tmp_path / "in"
    row = people(1)[0]
    send(
        folder,
        "1.json",
        [
            message(row, Id="1"),
            message(row, Id="2", Age=""),
            message(row, Id="3", Deck="Z9", Class="7"),
            message(row, Id="4", Deck=""),
            message(row, Name=""),
            "no json",
        ],
    )
    run(spark, stream, folder, scratch_path(spark, "checkpoint"))
    found = {layer: spark.table(stream.layers.table(layer)) for layer in ("bronze", "silver", "gold")}
    assert found["bronze"].count() == 6 and found["silver"].count() == 6
    assert sorted(r["Id"] for r in found["gold"].collect()) == ["1", "3", "4"]
    silver = {r["Id"]: r for r in found["silver"].collect()}
    assert silver["2"]["Age"] is None and silver["2"]["Fare"] is not None and silver["2"]["Class_2"] == 1.0
    hot = ["Class_1", "Class_2", "Class_3", "Deck_A1", "Deck_B2_C3"]
    assert [silver["3"][n] for n in hot] == [0.0] * 5
    assert [silver["4"][n] for n in hot] == [0.0, 1.0, 0.0, 0.0, 0.0]


def test_stream_adds_to_tables_of_the_batch_jobs(spark, tmp_path, database, fitted):
    layers = layers_of(database, True)
    ingest_csv(spark, str(write_csv(tmp_path / "raw", FIELDS, people())), layers)
    preparation = build_features(spark, layers, SPEC)
    registry = Registry(database, scratch_path(spark, "models"))
    registry.create(spark)
    registry.register(spark, MODEL, "m")
    score_by_join(spark, layers, SPEC, registry, "m")
    before = tables(spark, layers)
    send(tmp_path / "in", "1.json", [message(r, Id=f"9{r[0]}") for r in people(6)])
    run(spark, LayerStream(FIELDS, SPEC, layers, preparation, registry.load(spark, "m")), tmp_path / "in", scratch_path(spark, "c"))
    after = tables(spark, layers)
    assert [len(after[k]) - len(before[k]) for k in ("bronze", "silver", "gold")] == [6, 6, 6]


def test_stream_to_table_with_checkpoint(spark, tmp_path, database):
    folder, checkpoint = tmp_path / "in", scratch_path(spark, "checkpoint")
    for i in range(2):
        send(folder, f"{i}.json", [message(r) for r in people(5)])
        for _ in range(2):
            raw = decode_json(read_messages(spark, "text", {}, str(folder)), FIELDS)
            assert to_table(raw, f"{database}.raw", checkpoint, available_now=True).awaitTermination(SECONDS)
        assert spark.table(f"{database}.raw").count() == 5 * (i + 1)


def test_console_and_waiting(spark, tmp_path):
    send(tmp_path / "in", "1.json", [message(people(1)[0])])
    raw = decode_json(read_messages(spark, "text", {}, str(tmp_path / "in")), FIELDS)
    spark.streams.resetTerminated()
    query = console(raw, available_now=True)
    assert await_any(spark, SECONDS)
    assert not query.isActive and query.exception() is None
    spark.streams.resetTerminated()


def test_stream_needs_a_streamed_format(spark, tmp_path, database, fitted):
    stream = LayerStream(FIELDS, SPEC, layers_of(database), fitted, MODEL)
    send(tmp_path / "in", "1.json", ["{}"])
    with pytest.raises(ValueError, match="streamed"):
        stream.start(read_messages(spark, "text", {}, str(tmp_path / "in")), scratch_path(spark, "c"))


def test_each_checkpoint_is_its_own_stream():
    assert stream_id("/a/b") == stream_id("/a/b/") != stream_id("/a/c")
