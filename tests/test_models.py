"""Split, logistic regression, accuracy and the registry."""

from __future__ import annotations

import numpy as np
import pytest

from strataflow.operators import (
    LinearClassifier,
    Registry,
    accuracy,
    fit,
    fit_logistic,
    hash_bucket,
    hash_split,
    split_target,
    to_vectors,
)
from strataflow.plans import train
from strataflow.sources import scratch_path
from strataflow.spec import FeatureSpec


def newton(x, y, c=1.0):
    """Minimum of c * log loss + |w|^2 / 2 with a free intercept."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        w -= np.linalg.solve(c * a.T @ (a * (p * (1 - p))[:, None]) + penalty, c * a.T @ (p - y) + penalty @ w)
    return w[:-1], w[-1]


@pytest.fixture(scope="module")
def points():
    draw = np.random.default_rng(5)
    x = draw.random((400, 3))
    y = (x @ [2.0, -3.0, 0.5] + draw.normal(size=400) > 0).astype(int)
    return x, y


@pytest.fixture(scope="module")
def table(spark, points):
    x, y = points
    rows = [(i, *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id bigint, `a.b` double, c double, d double, label int")


FEATURES = ["a.b", "c", "d"]


@pytest.mark.parametrize("c", [1.0, 0.1])
def test_weights_match_newton(table, points, c):
    model = fit_logistic(table, "label", FEATURES, c=c, tol=1e-10)
    weights, intercept = newton(*points, c)
    assert np.allclose(model.weights[0], weights, atol=1e-5)
    assert np.isclose(model.intercepts[0], intercept, atol=1e-5)


def test_weights_do_not_depend_on_partitioning(table):
    one, many = (fit_logistic(table.repartition(n), "label", FEATURES) for n in (1, 7))
    assert np.allclose(one.weights, many.weights, atol=1e-7)


def test_prediction_is_the_sign_of_the_margin(table, points):
    model = fit_logistic(table, "label", FEATURES)
    x, _ = points
    expected = (x @ np.array(model.weights[0]) + model.intercepts[0] > 0).astype(int)
    found = {r["id"]: r["predicted"] for r in model.predict(table, "predicted").collect()}
    assert [found[i] for i in range(len(x))] == list(expected)


def test_null_feature_gives_null_prediction(spark):
    model = LinearClassifier("y", ("a", "b"), (3, 8), ((1.0, 0.0),), (0.0,))
    rows = spark.createDataFrame([(1, 1.0, None), (2, 1.0, 0.0), (3, -1.0, 0.0), (4, 0.0, 0.0)], "id int, a double, b double")
    predicted = model.predict(rows)
    assert {r["id"]: r["y"] for r in predicted.collect()} == {1: None, 2: 8, 3: 3, 4: 3}
    assert predicted.schema["y"].dataType.simpleString() == "bigint"


def test_more_than_two_classes(spark):
    draw = np.random.default_rng(1)
    x = draw.random((600, 2))
    y = np.where(x[:, 0] > 0.6, 5, np.where(x[:, 1] > 0.5, 9, 2))
    rows = spark.createDataFrame([(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "id int, a double, b double, y int")
    model = fit_logistic(rows, "y", ["a", "b"])
    assert model.classes == (2, 5, 9) and len(model.weights) == 3
    margins = x @ np.array(model.weights).T + np.array(model.intercepts)
    expected = np.array(model.classes)[margins.argmax(axis=1)]
    found = {r["id"]: r["p"] for r in model.predict(rows, "p").collect()}
    assert [found[i] for i in range(len(x))] == list(expected)
    assert accuracy(model.predict(rows, "p"), "y", "p").first()["accuracy"] > 0.85
    nulls = spark.createDataFrame([(1, None, 1.0)], "id int, a double, b double")
    assert model.predict(nulls, "p").first()["p"] is None
    ties = LinearClassifier("y", ("a",), (1, 2, 3), ((0.0,), (1.0,), (1.0,)), (0.0, 0.0, 0.0))
    assert ties.predict(spark.createDataFrame([(2.0,)], "a double")).first()["y"] == 2


@pytest.mark.parametrize(
    "labels, message",
    [([1, 1], "one class"), ([1, None], "missing"), ([], "no rows")],
)
def test_labels_that_cannot_be_fitted(spark, labels, message):
    rows = spark.createDataFrame([(1.0, y) for y in labels], "x double, y int")
    with pytest.raises(ValueError, match=message):
        fit_logistic(rows, "y", ["x"])


def test_split_is_about_a_fifth_and_depends_on_the_key_only(spark):
    rows = spark.range(5000).selectExpr("id", "string(id % 50) AS name")
    kept, held_out = hash_split(rows, ["id"])
    assert kept.count() + held_out.count() == 5000
    assert 900 < held_out.count() < 1100
    again = hash_split(rows.repartition(5), ["id"])[1]
    assert sorted(r["id"] for r in again.collect()) == sorted(r["id"] for r in held_out.collect())
    other = hash_split(rows, ["id"], seed=7)[1]
    assert {r["id"] for r in other.collect()} != {r["id"] for r in held_out.collect()}
    kept, held_out = hash_split(rows, ["name"], 0.3)
    assert not {r["name"] for r in kept.collect()} & {r["name"] for r in held_out.collect()}
    with pytest.raises(ValueError):
        hash_split(rows, ["id"], 1.0)


def test_split_keeps_rows_without_key(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    kept, held_out = hash_split(rows, ["k", "x"])
    assert kept.count() + held_out.count() == 2
    assert rows.select(hash_bucket(["k"]).alias("b")).filter("b IS NULL").count() == 0


def test_split_target(table):
    features, target = split_target(table, "label", ["id"])
    assert features.columns == FEATURES and target.columns == ["label"]


def test_accuracy_counts_a_missing_prediction_as_wrong(spark):
    rows = spark.createDataFrame([(1, 1), (0, 1), (1, None), (0, 0)], "y int, p int")
    assert accuracy(rows, "y", "p").first()["accuracy"] == 0.5


def test_registry(spark, database, table):
    registry = Registry(database, scratch_path(spark, "models"))
    spec = FeatureSpec(("id",), (), ("a.b", "c", "d"), "label")
    first = train(spark, table, spec, registry, "m", "trial")
    second = train(spark, table, spec, registry, "m", "trial", c=0.01)
    other = train(spark, table, spec, registry, "other")
    assert (first.version, second.version, other.version) == (1, 2, 1)
    assert 0.5 < first.accuracy <= 1
    assert registry.load(spark, "m") == first.model
    assert registry.load(spark, "m", 2) == second.model != first.model
    runs = {(r["run_id"], r["experiment"], r["metric"]): r["value"] for r in registry.runs(spark).collect()}
    assert runs[(first.run_id, "trial", "accuracy")] == first.accuracy and len(runs) == 3
    rows = {r["version"]: r["run_id"] for r in registry.versions(spark, "m").collect()}
    assert rows == {1: first.run_id, 2: second.run_id}
    with pytest.raises(ValueError, match="no version 3"):
        registry.load(spark, "m", 3)


def test_registering_never_replaces_a_version(spark, database):
    registry = Registry(database, scratch_path(spark, "models"))
    registry.create(spark)
    a = LinearClassifier("y", ("x",), (0, 1), ((1.0,),), (0.0,))
    b = LinearClassifier("y", ("x",), (0, 1), ((2.0,),), (0.0,))
    a.save(spark, f"{registry.root}/m/v1")  # written by someone else, not yet in the table
    assert registry.register(spark, b, "m") == 2
    assert LinearClassifier.load(spark, f"{registry.root}/m/v1") == a
    assert registry.load(spark, "m", 2) == b


def test_model_on_vectors_predicts_as_the_one_on_columns(spark, database):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet").selectExpr(
        "p_partkey", "p_brand", "p_type", "p_retailprice", "int(p_size > 25) AS big"
    )
    spec = FeatureSpec(("p_partkey",), ("p_brand", "p_type"), ("p_retailprice",), "big")
    fitted = fit(part, spec)
    from strataflow.operators import transform

    wide = transform(part, fitted, ["p_partkey", "big"])
    vectors = to_vectors(part, fitted, ["p_partkey", "big"])
    a = fit_logistic(wide, "big", fitted.feature_names)
    b = fit_logistic(vectors, "big", fitted.feature_names, vector="features")
    assert np.allclose(a.weights, b.weights, atol=1e-5)
    registry = Registry(database, scratch_path(spark, "models"))
    registry.create(spark)
    loaded = registry.load(spark, "big", registry.register(spark, b, "big"))
    expected = {r["p_partkey"]: r["p"] for r in b.predict(wide, "p").collect()}
    assert {r["p_partkey"]: r["p"] for r in loaded.predict_vectors(vectors, output="p").collect()} == expected
    with pytest.raises(ValueError, match="not fitted on vectors"):
        a.predict_vectors(vectors)
