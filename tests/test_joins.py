"""Key joins against a brute-force join, with frequent keys on either side."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from plan import plan
from strataflow.operators import joins
from strataflow.operators.joins import common_type, join_column, join_on_keys, may_broadcast, repeatable_hashes, sketch_keys


def brute_force(left, right):
    return Counter((k, x, y) for k, x in left for l, y in right if k is not None and k == l)


def frames(spark, left, right):
    return spark.createDataFrame(left, "k bigint, x bigint"), spark.createDataFrame(right, "k bigint, y string")


HOT_LEFT = [(7 if i % 3 == 0 else i, i) for i in range(900)] + [(None, 1)] * 50
FLAT_RIGHT = [(i, f"y{i}") for i in range(600)] + [(None, "n")]
HOT_RIGHT = FLAT_RIGHT + [(13, f"z{i}") for i in range(300)]
FLAT_LEFT = [(i, i) for i in range(600)]


@pytest.mark.parametrize("limit", [1_000_000, 400, 10, 0])
@pytest.mark.parametrize(
    "left, right",
    [(HOT_LEFT, FLAT_RIGHT), (FLAT_LEFT, HOT_RIGHT), (HOT_LEFT, HOT_RIGHT), (FLAT_LEFT, FLAT_RIGHT), ([], FLAT_RIGHT)],
    ids=["left", "right", "both", "none", "empty"],
)
def test_join_is_whole_whatever_is_broadcast(spark, monkeypatch, left, right, limit):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
    a, b = frames(spark, left, right)
    found = Counter(tuple(r) for r in join_on_keys(a, b, ["k"]).collect())
    assert found == brute_force(left, right)


def test_same_key_frequent_on_both_sides(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 20)
    left, right = [(1, i) for i in range(60)], [(1, str(i)) for i in range(50)] + [(i, "s") for i in range(100)]
    a, b = frames(spark, left, right)
    assert Counter(tuple(r) for r in join_on_keys(a, b, ["k"]).collect()) == brute_force(left, right)


def test_frequent_keys_are_salted_in_one_join(spark):
    a, b = frames(spark, HOT_LEFT, FLAT_RIGHT)
    text = plan(join_on_keys(a, b, ["k"], broadcast_rows=10))
    assert text.count("SortMergeJoin") == 1 and text.count("Scan ExistingRDD") == 2
    assert "__salt" in text and "Broadcast" not in text and "Union" not in text


@pytest.mark.parametrize("limit", [400, 10, 0])
@pytest.mark.parametrize(
    "left_type, right_type",
    [
        ("string collate UTF8_LCASE", "string collate UTF8_LCASE"), ("string", "bigint"), ("int", "bigint"), ("int", "string"),
        ("decimal(12,2)", "decimal(12,2)"), ("decimal(10,1)", "decimal(12,3)"), ("decimal(8,0)", "bigint"), ("double", "double"),
        ("float", "double"), ("int", "double"), ("date", "date"), ("binary", "binary"),
    ],
)
def test_hot_keys_of_any_type_join_like_plain_ones(spark, left_type, right_type, limit):
    def typed(frame, kind):
        if kind == "date":
            return frame.selectExpr("date_add(date'2000-01-01', cast(k as int)) AS k", "* except (k)")
        text = kind in ("binary",)
        return frame.selectExpr(f"cast({'cast(k as string)' if text else 'k'} as {kind}) AS k", "* except (k)")

    a, b = frames(spark, HOT_LEFT, HOT_RIGHT)
    a, b = typed(a, left_type), typed(b, right_type)
    if "collate" in left_type:
        a = a.withColumn("k", F.concat(F.lit("K"), "k").cast(left_type))
        b = b.withColumn("k", F.concat(F.lit("k"), "k").cast(right_type))
    found = Counter((r["x"], r["y"]) for r in join_on_keys(a, b, ["k"], broadcast_rows=limit).collect())
    expected = Counter((r["x"], r["y"]) for r in a.join(b, a["k"] == b["k"]).collect())
    assert expected and found == expected


def test_zeros_and_nans_of_hot_keys_meet(spark):
    left = spark.createDataFrame([(v, i) for i in range(60) for v in (0.0, -0.0, float("nan"))], "k double, x int")
    right = spark.createDataFrame([(-0.0, "z"), (float("nan"), "n")] + [(float(i), "o") for i in range(1, 90)], "k double, y string")
    found = Counter(r["y"] for r in join_on_keys(left, right, ["k"], broadcast_rows=10).collect())
    assert found == {"z": 120, "n": 60}


def test_types_without_a_common_one_are_not_hashed():
    from pyspark.sql import types as T

    assert common_type(T.StringType(), T.DoubleType(), True) is None
    assert common_type(T.StringType(), T.LongType(), False) is None
    assert common_type(T.StringType("UTF8_LCASE"), T.StringType("UTF8_LCASE"), True) is None
    assert common_type(T.LongType(), T.DoubleType(), True) is None
    assert common_type(T.DecimalType(38, 0), T.DecimalType(38, 30), True) is None


def test_salt_does_not_hide_a_column_of_its_name(spark):
    a, b = frames(spark, HOT_LEFT, FLAT_RIGHT)
    found = join_on_keys(a.withColumnRenamed("x", "__salt"), b, ["k"], broadcast_rows=10)
    assert found.columns == ["k", "__salt", "y"]
    assert Counter(tuple(r) for r in found.collect()) == brute_force(HOT_LEFT, FLAT_RIGHT)


def test_what_was_not_counted_small_is_not_broadcast(spark, monkeypatch):
    a, b = frames(spark, FLAT_LEFT, FLAT_RIGHT)
    assert plan(join_on_keys(a, b, ["k"])).count("BroadcastHashJoin") == 1
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    text = plan(join_on_keys(a, b, ["k"]))
    assert "Union" not in text and "Broadcast" not in text and "SortMergeJoin" in text


def test_frequent_keys_with_many_partners_are_not_repeated_for_all_salts(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 30)
    left = [(i % 3, i) for i in range(300)] + [(100 + i, i) for i in range(300)]
    right = [(0, "a"), (1, "b"), (1, "c")] + [(2, f"y{i}") for i in range(40)] + [(100 + i, "z") for i in range(300)]
    a, b = frames(spark, left, right)
    (sketch, _) = sketch_keys([a, b], ["k"])
    assert len(sketch.frequent) == 3
    chosen = repeatable_hashes(b, ["k"], [b.schema["k"].dataType], sketch.frequent, 30, 1 << 20)
    expected = {r[0] for r in spark.range(2).selectExpr("xxhash64(id)").collect()}
    assert set(chosen) == expected
    assert Counter(tuple(r) for r in join_on_keys(a, b, ["k"]).collect()) == brute_force(left, right)


def test_sketch_finds_the_frequent_key(spark):
    a, b = frames(spark, HOT_LEFT, FLAT_RIGHT)
    left, right = sketch_keys([a.dropna(), b.dropna()], ["k"])
    assert (left.rows, right.rows) == (900, 600)
    assert len(left.frequent) == 1 and right.frequent == []


def test_sketch_of_many_keys_finds_every_frequent_one(spark):
    rows = spark.range(400_000).selectExpr("CASE WHEN id % 20 < 8 THEN -(id % 20) - 1 ELSE id END AS k")
    (found,) = sketch_keys([rows], ["k"])
    expected = {r[0] for r in spark.range(1, 9).selectExpr("xxhash64(-id)").collect()}
    assert set(found.frequent) == expected


def test_size_in_bytes_is_checked(spark, monkeypatch):
    rows = spark.range(10).selectExpr("id", "repeat('x', 100) AS text")
    assert may_broadcast(rows)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1000)
    assert not may_broadcast(rows)
    assert may_broadcast(rows.select("id"))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 9)
    assert not may_broadcast(rows.select("id"))


def test_two_keys_and_duplicates_multiply(spark):
    left = spark.createDataFrame([("1", "a", 1), ("1", "a", 2), ("1", "b", 3), (None, "a", 4)], "i string, n string, x int")
    right = spark.createDataFrame([("1", "a", 0, 9), ("1", "a", 1, 9), (None, "a", 1, 9)], "i string, n string, c int, u int")
    found = join_column(left, right, ["i", "n"], "c")
    assert found.columns == ["i", "n", "x", "c"]
    assert sorted((r["x"], r["c"]) for r in found.collect()) == [(1, 0), (1, 1), (2, 0), (2, 1)]


def test_keys_of_different_types(spark):
    left = spark.createDataFrame([("1", 1)] * 50 + [("02", 2)], "k string, x int")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, y string")
    assert Counter(r["y"] for r in join_on_keys(left, right, ["k"]).collect()) == {"a": 50, "b": 1}
    small = spark.createDataFrame([(1, "a")], "k int, y string")
    wide = spark.createDataFrame([(1, 5)] * 3, "k bigint, x int")
    assert join_on_keys(wide, small, ["k"]).count() == 3


def test_columns_of_equal_name_on_both_sides(spark):
    left = spark.createDataFrame([(1, "l")], "k int, `v.w` string")
    right = spark.createDataFrame([(1, "r", "o")], "k int, `v.w` string, `other col` string")
    assert join_column(left, right, ["k"], "other col").first() == (1, "l", "o")


@pytest.mark.parametrize("m, n", [(1000, 1000), (100_000, 10), (10, 100_000), (5_000, 300), (1, 1)])
@pytest.mark.parametrize("partitions", [1, 8, 200])
def test_grid_repeats_as_little_as_a_grid_can(m, n, partitions):
    height, width = joins.grid_shape(m, n, partitions)
    cells = height * width
    assert 2 * max(joins.SALTS, joins.CELLS_PER_PARTITION * partitions) > cells >= max(joins.SALTS, joins.CELLS_PER_PARTITION * partitions)
    repeated = m * width + n * height
    assert all(repeated <= m * (cells // r) + n * r for r in (1 << i for i in range(cells.bit_length())))


def test_each_pair_of_a_grid_meets_once(spark):
    left, right = spark.range(50).selectExpr("7L AS k", "id AS x"), spark.range(30).selectExpr("7L AS k", "id AS y")
    h = spark.range(1).selectExpr("xxhash64(7L)").first()[0]
    types = [left.schema["k"].dataType]
    for shape in [(8, 4), (1, 16), (16, 1), (2, 32)]:
        cells = [joins._in_cells(df, ["k"], types, {shape: [h], (3, 5): [h + 1]}, "s", i) for i, df in enumerate((left, right))]
        assert (cells[0].count(), cells[1].count()) == (50 * shape[1], 30 * shape[0])
        met = cells[0].join(cells[1], ["k", "s"])
        assert met.count() == 1500 and met.select("x", "y").distinct().count() == 1500
        assert met.agg(F.min("s") >= 0, F.max("s") < shape[0] * shape[1]).first() == (True, True)


def test_work_of_a_key_with_a_third_of_both_sides_is_spread(spark, monkeypatch):
    """Rows that a task makes: with one cell per key a single task made nearly all of them."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 100)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1 << 20)
    left = spark.range(3000).selectExpr("IF(id % 3 = 0, -1L, id) AS k", "id AS x")
    right = spark.range(2400).selectExpr("IF(id % 3 = 1, -1L, id) AS k", "concat('y', id) AS y")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_on_keys(left, right, ["k"])
        made = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("task")).count().collect())
        plain = joins._inner(left, right.hint("merge"), ["k"], ["y"])
        lumped = sorted(r["count"] for r in plain.groupBy(F.spark_partition_id().alias("task")).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(made) == sum(lumped) >= 1000 * 800 and lumped[-1] >= 1000 * 800
    assert len(made) == 8 and made[-1] <= 3 * made[len(made) // 2]


@pytest.mark.parametrize("left_type, right_type", [("bigint", "bigint"), ("int", "bigint"), ("string", "string")])
def test_tasks_grow_with_the_pairs_of_frequent_keys(spark, monkeypatch, left_type, right_type):
    """Twice the rows on both sides make four times the pairs: more tasks, none of which makes more of them."""
    monkeypatch.setattr(joins, "PAIRS_PER_TASK", 4_000, raising=False)
    most = []
    for size in (1, 2):
        left = spark.range(400 * size).selectExpr(f"cast(id % 5 as {left_type}) AS k", "id AS x")
        right = spark.range(200 * size).selectExpr(f"cast(id % 5 as {right_type}) AS k", "id AS y")
        joined = join_on_keys(left, right, ["k"], broadcast_rows=10)
        made = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        assert sum(made) == 16_000 * size * size
        assert joined.select("x", "y").distinct().count() == sum(made)
        assert plan(joined).count("Exchange") == 2
        most.append(max(made))
    assert max(most) <= 5 * 4_000


@pytest.mark.parametrize("wide_right", [True, False])
def test_rounds_of_held_rows_stay_short(spark, monkeypatch, wide_right):
    """The rows of a cell that come again for each row of the other side grew with the tables, and with them the bytes of each row of the result."""
    monkeypatch.setattr(joins, "HELD_ROWS", 8, raising=False)
    left, right = spark.range(3000).selectExpr("id % 5 AS k", "id AS x"), spark.range(1000).selectExpr("id % 5 AS k", "id AS y", "-id AS z")
    a, b = (left, right) if wide_right else (right, left)
    joined = join_on_keys(a, b, ["k"], broadcast_rows=10)
    runs = []
    for task in joined.select("y", "x").rdd.glom().collect():
        changes = [i for i, (row, before) in enumerate(zip(task[1:], task), 1) if row[0] != before[0]]
        runs += [end - begin for begin, end in zip([0, *changes], [*changes, len(task)])]
    assert sum(runs) == 600_000
    assert joined.select("x", "y").distinct().count() == 600_000
    assert max(runs) <= 4 * 8 and sum(runs) / len(runs) <= 8


def test_cells_of_short_rounds_are_about_as_many():
    assert joins.short_rounds((8, 16), 200, 100, True) == (8, 16)
    assert joins.short_rounds((8, 16), 200_000, 14_400, True) == (1024, 1)
    assert joins.short_rounds((8, 16), 200_000, 14_400, False) == (2, 64)
