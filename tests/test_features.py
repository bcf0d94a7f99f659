"""Fitting and applying features, on a small table worked out by hand."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException

from plan import plan
from strataflow.functions import complete_rows, number, sanitize_names
from strataflow.operators import (
    Preparation,
    category_pairs,
    fit,
    fit_categories,
    load_preparation,
    save_preparation,
    to_vectors,
    transform,
)
from strataflow.plans import feature_rows
from strataflow.sources import scratch_path
from strataflow.spec import FeatureSpec

COLUMNS = "id string, name string, class string, deck string, age string, fare string"
ROWS = [
    ("1", "a", "1", "F G73", "10", "0"),
    ("2", "b", "2", None, "20", "50"),
    ("3", "c", "10", "B5", None, "100"),
    ("4", "d", None, "C1", "30", "25.5"),
    ("5", "e", "2", "B5", "40", None),
    ("6", "f", "1", "B5", "50", "99"),
]
SPEC = FeatureSpec(("id", "name"), ("class", "deck"), ("age", "fare"))


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


def by_id(df):
    return {row["id"]: row for row in df.collect()}


def test_fit_uses_the_complete_rows_of_each_group(raw):
    fitted = fit(raw, SPEC)
    assert fitted.categories == {"class": ("1", "10", "2"), "deck": ("B5", "F G73")}
    assert fitted.ranges == {"age": (10.0, 50.0), "fare": (0.0, 99.0)}


def test_features_stay_with_their_key(raw):
    found = by_id(feature_rows(raw, fit(raw, SPEC), SPEC))
    names = ["class_1", "class_10", "class_2", "deck_B5", "deck_F_G73", "age", "fare"]
    values = {key: [row[n] for n in names] for key, row in found.items()}
    assert values == {
        "1": [1, 0, 0, 0, 1, 0.0, 0.0],
        "2": [None, None, None, None, None, 0.25, 50 / 99],
        "3": [0, 1, 0, 1, 0, None, None],
        "4": [None, None, None, None, None, 0.5, 25.5 / 99],
        "5": [0, 0, 1, 1, 0, None, None],
        "6": [1, 0, 0, 1, 0, 1.0, 1.0],
    }
    assert {key: row["name"] for key, row in found.items()} == {r[0]: r[1] for r in ROWS}


def test_result_does_not_depend_on_partitioning(raw):
    expected = feature_rows(raw, fit(raw, SPEC), SPEC)
    for parts in (1, 3, 7):
        moved = raw.repartition(parts, "name")
        fitted = fit(moved, SPEC)
        assert fitted == fit(raw, SPEC)
        assert by_id(feature_rows(moved, fitted, SPEC)) == by_id(expected)


def test_unknown_category_raises_when_strict(spark, raw):
    fitted = fit(raw, SPEC)
    new = spark.createDataFrame([("7", "g", "9", "B5", "1", "1")], COLUMNS)
    with pytest.raises(PySparkException, match="unknown category in class: 9"):
        feature_rows(new, fitted, SPEC).collect()


def test_unknown_category_in_an_incomplete_row_is_not_looked_at(spark, raw):
    new = spark.createDataFrame([("7", "g", "9", None, "10", "99")], COLUMNS)
    row = feature_rows(new, fit(raw, SPEC), SPEC).first()
    assert row["class_1"] is None and row["age"] == 0.0


def test_unknown_and_missing_categories_become_zeros_when_ignored(spark, raw):
    fitted = fit(raw, SPEC)
    new = spark.createDataFrame([("7", "g", "9", "B5", None, "198"), ("8", "h", "1", None, "60", "0")], COLUMNS)
    found = by_id(feature_rows(new, fitted, SPEC, on_unknown="ignore", incomplete="encode"))
    assert [found["7"][n] for n in ("class_1", "class_10", "class_2", "deck_B5", "deck_F_G73")] == [0, 0, 0, 1, 0]
    assert [found["8"][n] for n in ("class_1", "class_10", "class_2", "deck_B5", "deck_F_G73")] == [1, 0, 0, 0, 0]
    # each number stands alone, and values outside the range are not clipped
    assert found["7"]["age"] is None and found["7"]["fare"] == 2.0
    assert found["8"]["age"] == 1.25 and found["8"]["fare"] == 0.0


def test_constant_column(spark):
    rows = spark.createDataFrame([("1", 5.0), ("2", 5.0)], "id string, x double")
    spec = FeatureSpec(("id",), (), ("x",))
    fitted = fit(rows, spec)
    assert [r["x"] for r in feature_rows(rows, fitted, spec).collect()] == [0.0, 0.0]
    other = spark.createDataFrame([("3", 7.0)], "id string, x double")
    assert feature_rows(other, fitted, spec).first()["x"] == 2.0


@pytest.mark.parametrize("bad", ["x", "inf", "1,5", "12d", " 1F ", ""])
def test_bad_number(spark, bad):
    rows = spark.createDataFrame([("1", "1", "2"), ("2", bad, "3"), ("3", "3", "4")], "id string, x string, y string")
    spec = FeatureSpec(("id",), (), ("x", "y"))
    with pytest.raises(PySparkException, match="not a finite number"):
        fit(rows, spec)
    fitted = fit(rows, spec, on_bad="null")
    assert fitted.ranges == {"x": (1.0, 3.0), "y": (2.0, 4.0)}
    found = by_id(feature_rows(rows, fitted, spec, on_bad="null"))
    assert [found[k]["x"] for k in "123"] == [0.0, None, 1.0]
    assert [found[k]["y"] for k in "123"] == [0.0, None, 1.0]
    alone = by_id(feature_rows(rows, fitted, spec, on_bad="null", incomplete="encode"))
    assert [alone[k]["y"] for k in "123"] == [0.0, 0.5, 1.0]


def test_bad_number_in_an_incomplete_row_is_not_looked_at(spark):
    rows = spark.createDataFrame([("1", "1", "2"), ("2", "x", None), ("3", "3", "4")], "id string, x string, y string")
    spec = FeatureSpec(("id",), (), ("x", "y"))
    fitted = fit(rows, spec)
    assert fitted.ranges == {"x": (1.0, 3.0), "y": (2.0, 4.0)}
    assert by_id(feature_rows(rows, fitted, spec))["2"]["x"] is None


def test_numbers_do_not_depend_on_ansi_mode(spark):
    rows = spark.createDataFrame([("x",)], "x string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException, match="not a finite number in x: x"):
            rows.select(number("x", rows.schema["x"].dataType)).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_nan_is_missing(spark):
    rows = spark.createDataFrame([("1", 1.0, "1"), ("2", float("nan"), "2"), ("3", 3.0, "NaN")], "id string, x double, y string")
    spec = FeatureSpec(("id",), (), ("x", "y"))
    fitted = fit(rows, spec)
    assert fitted.ranges == {"x": (1.0, 1.0), "y": (1.0, 1.0)}
    found = by_id(feature_rows(rows, fitted, spec))
    assert [(found[k]["x"], found[k]["y"]) for k in "123"] == [(0.0, 0.0), (None, None), (None, None)]
    assert complete_rows(rows.select("x")).count() == 2


def test_categories_sort_as_text(spark):
    rows = spark.createDataFrame([(c,) for c in ["2", "é", "10", "1", "a", "B"]], "x string")
    assert fit_categories(rows, ["x"]) == {"x": ("1", "10", "2", "B", "a", "é")}


@pytest.mark.parametrize("pair", [("F G73", "F_G73"), ("a", "A")])
def test_name_collision(spark, pair):
    rows = spark.createDataFrame([(p,) for p in pair], "x string")
    with pytest.raises(ValueError, match="collide"):
        fit(rows, FeatureSpec(("id",), ("x",)))


def test_feature_name_equal_to_a_key(spark):
    rows = spark.createDataFrame([("k", "1")], "x_1 string, x string")
    spec = FeatureSpec(("x_1",), ("x",))
    with pytest.raises(ValueError, match="collide"):
        feature_rows(rows, fit(rows, spec), spec)


def test_odd_names(spark):
    rows = spark.createDataFrame([("1", "u.v", 2.0), ("2", "w`x", 4.0)], "`the id` string, `a.b` string, `c d` double")
    spec = FeatureSpec(("the id",), ("a.b",), ("c d",))
    found = feature_rows(rows, fit(rows, spec), spec)
    assert found.columns == ["the id", "a.b_u.v", "a.b_w`x", "c d"]
    assert sorted(tuple(r) for r in found.collect()) == [("1", 1.0, 0.0, 0.0), ("2", 0.0, 1.0, 1.0)]
    assert sanitize_names(rows).columns == ["the_id", "a.b", "c_d"]
    with pytest.raises(ValueError, match="collide"):
        sanitize_names(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))


def test_limit_of_categories(spark):
    rows = spark.range(50).selectExpr("string(id) AS x", "'c' AS y")
    assert len(fit_categories(rows, ["x", "y"], limit=51)["x"]) == 50
    with pytest.raises(ValueError, match="more than 50 categories"):
        fit_categories(rows, ["x", "y"], limit=50)


def test_nothing_to_fit(spark):
    rows = spark.createDataFrame([("1", None, None)], "id string, x string, y double")
    with pytest.raises(ValueError, match="no row is complete"):
        fit_categories(rows, ["x"])
    with pytest.raises(ValueError, match="no row is complete"):
        fit(rows, FeatureSpec(("id",), (), ("y",)))


def test_preparation_survives_saving(spark, raw):
    fitted = fit(raw, SPEC)
    path = scratch_path(spark, "test")
    save_preparation(spark, fitted, path)
    assert load_preparation(spark, path, SPEC) == fitted
    smaller = Preparation(fitted.categories)
    save_preparation(spark, smaller, path)
    assert load_preparation(spark, path, FeatureSpec(("id",), ("class", "deck"))) == smaller


@pytest.mark.parametrize("options", [{}, {"on_unknown": "ignore", "incomplete": "encode"}])
def test_vectors_hold_the_same_values_as_columns(spark, options):
    pick = random.Random(3)
    rows = [
        (str(i), pick.choice(["a", "b", "c d", None]), pick.choice(["1", "2", "3", "4", "5"]), pick.choice([1.0, 2.5, None]))
        for i in range(200)
    ]
    table = spark.createDataFrame(rows, "id string, x string, y string, z double")
    spec = FeatureSpec(("id",), ("x", "y"), ("z",))
    fitted = fit(table.filter("y <> '5'") if options else table, spec)
    wide = complete_rows(transform(table, fitted, ["id"], **options))
    vectors = to_vectors(table, fitted, ["id"], **options)
    expected = {r["id"]: [r[n] for n in fitted.feature_names] for r in wide.collect()}
    assert expected and {r["id"]: list(r["features"].toArray()) for r in vectors.collect()} == expected


def test_vectors_raise_on_unknown_category(spark):
    rows = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, x string")
    with pytest.raises(PySparkException, match="unknown category in x: b"):
        to_vectors(rows, Preparation({"x": ("a",)}), ["id"]).collect()


def test_fitting_reads_only_its_columns_and_pushes_its_filter(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = plan(category_pairs(orders, ["o_orderstatus", "o_orderpriority"]))
    assert "IsNotNull(o_orderstatus), IsNotNull(o_orderpriority)" in text
    assert "ReadSchema: struct<o_orderstatus:string,o_orderpriority:string>" in text
    # one partial aggregate before the only shuffle
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2


def test_transform_does_not_shuffle(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    spec = FeatureSpec(("o_orderkey",), ("o_orderstatus",), ("o_totalprice",))
    text = plan(feature_rows(orders, fit(orders, spec), spec))
    assert "Exchange" not in text and "Python" not in text


def test_expressions_grow_with_the_number_of_columns_only(spark):
    def length(n):
        names = [f"x{i}" for i in range(n)]
        rows = spark.createDataFrame([("k", *["1"] * n)], ", ".join(["id string", *[f"{c} string" for c in names]]))
        fitted = Preparation({}, {c: (0.0, 1.0) for c in names})
        return len(plan(transform(rows, fitted, ["id"])))

    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    assert length(40) < 5 * length(10)
