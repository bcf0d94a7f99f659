"""Training with weights in a table against Spark ML's weights on the driver."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataflow import FeatureSpec
from strataflow.operators import fit, fit_category_table, fit_logistic, sparse_features, table_classifier, transform
from strataflow.operators.table_classifier import fit_table_logistic
from strataflow.sources import scratch_path

DIRECTORY = "/root/testdata/sf0.001"


def parts(spark):
    part = spark.read.parquet(f"{DIRECTORY}/part.parquet")
    return part.withColumn("large", ((F.col("p_size") + F.length("p_brand") + F.col("p_partkey") % 7) > 30).cast("bigint"))


def test_the_same_weights_as_on_the_driver(spark):
    rows = parts(spark)
    spec = FeatureSpec(("p_partkey",), ("p_brand",), ("p_retailprice", "p_size"))
    table = fit_category_table(rows, spec, scratch_path(spark, "categories"))
    sparse = sparse_features(rows, table, ["p_partkey", "large"])
    model = fit_table_logistic(sparse, "large", table, scratch_path(spark, "fit"), max_iter=60)
    wide = fit(rows, spec)
    expected = fit_logistic(_wide(rows, wide), "large", wide.feature_names, tol=1e-10)
    found = [r["weight"] for r in model.weights(spark).orderBy("place").collect()]
    assert found == pytest.approx([*expected.weights[0], expected.intercepts[0]], abs=2e-3)
    scores = {r["p_partkey"]: r["margin"] for r in model.margins(sparse, table, ["p_partkey"]).collect()}
    by_hand = {r["p_partkey"]: r["m"] for r in _wide(rows, wide).select("p_partkey", expected.margin().alias("m")).collect()}
    assert scores == pytest.approx(by_hand, abs=1e-2)
    classes = model.predict(sparse, table, ["p_partkey"]).where("large = 1").count()
    assert classes == sum(m > 0 for m in scores.values())


def test_joins_by_key_give_the_same_weights_as_by_broadcast(spark, monkeypatch):
    rows = parts(spark)
    spec = FeatureSpec(("p_partkey",), ("p_brand", "p_mfgr") if "p_mfgr" in rows.columns else ("p_brand",), ("p_size",))
    table = fit_category_table(rows.where("p_partkey > 20"), spec, scratch_path(spark, "categories"))
    sparse = sparse_features(rows, table, ["p_partkey", "large"], on_unknown="ignore")
    found = []
    for broadcast in (True, False):
        if not broadcast:
            monkeypatch.setattr(table_classifier, "may_broadcast", lambda lookup: False)
        with pytest.warns(UserWarning, match="gradient"):
            model = fit_table_logistic(sparse, "large", table, scratch_path(spark, "fit"), max_iter=2)
        margins = model.margins(sparse, table, ["p_partkey"])
        found.append([sorted(map(tuple, df.collect())) for df in (model.weights(spark), margins)])
    for one, two in zip(*found):
        assert [x for r in one for x in r] == pytest.approx([x for r in two for x in r])


def _wide(rows, prepared):
    return transform(rows, prepared, keep=["p_partkey", "large"])


def test_a_category_a_row(spark):
    rows = parts(spark)
    spec = FeatureSpec(("p_partkey",), ("p_name", "p_brand"), ())
    table = fit_category_table(rows, spec, scratch_path(spark, "categories"))
    sparse = sparse_features(rows, table, ["p_partkey", "large"])
    model = fit_table_logistic(sparse, "large", table, scratch_path(spark, "fit"))
    assert model.slope <= 1e-6 * rows.count() and model.weights(spark).count() == table.size + 1


def test_other_than_two_classes_raise(spark):
    rows = parts(spark)
    spec = FeatureSpec(("p_partkey",), ("p_brand",), ())
    table = fit_category_table(rows, spec, scratch_path(spark, "categories"))
    for value in ("1L", "p_partkey % 3", "nullif(large, 0)"):
        bad = sparse_features(rows.withColumn("large", F.expr(value)), table, ["large"])
        with pytest.raises(ValueError, match="two classes"):
            fit_table_logistic(bad, "large", table, scratch_path(spark, "fit"))


def test_two_loops_give_the_newton_step_of_a_quadratic():
    import numpy as np

    from strataflow.operators import table_classifier as t

    rng = np.random.default_rng(1)
    a = np.diag([1.0, 2.0, 5.0])
    steps = [rng.normal(size=3) for _ in range(3)]
    for i, s in enumerate(steps):  # conjugate, as exact steps are
        for o in steps[:i]:
            s -= (s @ a @ o) / (o @ a @ o) * o
    g = rng.normal(size=3)
    s = np.zeros((t.MEMORY, 3))
    s[-3:] = steps
    basis = np.vstack([s, s @ a, g])
    direction = t._direction(basis @ basis.T, 3) @ basis
    assert direction == pytest.approx(-np.linalg.solve(a, g))
