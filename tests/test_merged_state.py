"""Fitted state of two sets of rows against a fit of all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataflow.operators import fit, fit_category_table, fit_table_logistic, sparse_features
from strataflow.operators.categories import merge_category_tables
from strataflow.operators.features import merge_preparations
from strataflow.sources import scratch_path
from strataflow.spec import FeatureSpec

SPEC = FeatureSpec(("id",), ("a", "b"), ("x",))


@pytest.fixture(scope="module")
def rows(spark):
    """``a`` has ever new categories, ``b`` has the same three, ``x`` grows; a third of the rows shares a category."""
    a = "CASE WHEN id % 3 = 0 THEN 'all' ELSE concat('c', lpad(1000 - id, 4, '0')) END AS a"
    return spark.range(120).selectExpr("id", a, "concat('v', id % 3) AS b", "CASE WHEN id = 7 THEN NULL ELSE id * 1.5D END AS x")


def placed(spark, table):
    return {(r["column"], r["category"]): r["place"] for r in table.places(spark).collect()}


def fitted(spark, rows):
    return fit_category_table(rows, SPEC, scratch_path(spark, "categories"))


def merged(spark, old, new):
    return merge_category_tables(spark, old, new, scratch_path(spark, "merged"))


def test_merged_tables_equal_a_fit_of_all(spark, rows):
    parts = [fitted(spark, rows.where(F.col("id").between(low, low + 39))) for low in (0, 40, 80)]
    whole, found, old = fitted(spark, rows), parts[0], {}
    for part in parts[1:]:
        old = placed(spark, found)
        first, found = found, merged(spark, found, part)
        now = placed(spark, found)
        assert {k: now[k] for k in old} == old and found.numbers == parts[0].numbers
        new = sorted(set(now) - set(old))
        assert new and [now[k] for k in new] == list(range(first.size, first.size + len(new)))
        assert found.path != first.path and placed(spark, first) == old
    assert set(now) == set(placed(spark, whole)) and found.sizes == whole.sizes and found.ranges == whole.ranges
    assert sorted([*now.values(), *found.numbers]) == list(range(found.size)) and found.size == whole.size
    for i, blocks in enumerate(found.blocks):
        assert sorted(p for (c, _), p in now.items() if c == i) == [p for a, b in blocks for p in range(a, b)]


def test_merging_again_changes_nothing(spark, rows):
    a, b = fitted(spark, rows.where("id < 50")), fitted(spark, rows.where("id >= 30"))
    once = merged(spark, a, b)
    twice = merged(spark, once, b)
    assert placed(spark, twice) == placed(spark, once) and (twice.blocks, twice.ranges) == (once.blocks, once.ranges)


def test_features_of_a_merged_table(spark, rows):
    table = merged(spark, fitted(spark, rows.where("id >= 60")), fitted(spark, rows.where("id < 60")))
    places = placed(spark, table)
    (low, high), number = table.ranges["x"], table.numbers[0]
    found = {r["id"]: r["features"] for r in sparse_features(rows, table, ["id"]).collect()}
    assert len(found) == 119
    for r in rows.where("x is not null").collect():
        entries = {places[0, r["a"]]: 1.0, places[1, r["b"]]: 1.0, number: (r["x"] - low) / (high - low)}
        entries = {i: v for i, v in entries.items() if v}
        assert found[r["id"]]["indices"] == sorted(entries) and found[r["id"]]["size"] == table.size
        assert dict(zip(found[r["id"]]["indices"], found[r["id"]]["values"])) == pytest.approx(entries)


def test_training_on_a_merged_table(spark, rows):
    labelled = rows.withColumn("y", F.col("id") * 7 % 5 < 2)
    weights = []
    for table in (fitted(spark, rows), merged(spark, fitted(spark, rows.where("id % 2 = 1")), fitted(spark, rows.where("id % 2 = 0")))):
        sparse = sparse_features(labelled, table, ["y"])
        model = fit_table_logistic(sparse, "y", table, scratch_path(spark, "weights"))
        by_place = {r["place"]: r["weight"] for r in model.weights(spark).collect()}
        named = {name: by_place.get(place, 0.0) for name, place in placed(spark, table).items()}
        weights.append(named | {"x": by_place[table.numbers[0]], "free": by_place[table.size]})
    assert weights[0].keys() == weights[1].keys()
    assert all(abs(weights[0][k] - weights[1][k]) < 2e-3 for k in weights[0])


def test_merged_preparations(spark, rows):
    a, b = fit(rows.where("id >= 60"), SPEC), fit(rows.where("id < 60"), SPEC)
    both, whole = merge_preparations(a, b), fit(rows, SPEC)
    assert both.ranges == whole.ranges and merge_preparations(both, b) == both
    for name, values in a.categories.items():
        assert both.categories[name][: len(values)] == values
        assert sorted(both.categories[name]) == list(whole.categories[name])
    with pytest.raises(ValueError):
        merge_preparations(a, fit(rows, FeatureSpec(("id",), ("a",), ("x",))))


def test_other_columns_do_not_merge(spark, rows):
    other = fit_category_table(rows, FeatureSpec(("id",), ("b", "a"), ("x",)), scratch_path(spark, "categories"))
    with pytest.raises(ValueError):
        merged(spark, fitted(spark, rows), other)
