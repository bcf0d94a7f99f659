"""One-hot features of columns with any number of categories: the categories stay a table, no list of them is on the driver."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.columns import all_present, column, combine, number, numbers_present
from strataflow.operators.features import category_pairs, fit_ranges, merge_ranges
from strataflow.operators.joins import join_column, may_broadcast
from strataflow.spec import FeatureSpec

PLACES = "column int, category string, place bigint"


@dataclass(frozen=True)
class CategoryTable:
    """Fitted state under a path: for each column its sorted categories and their places among all features.

    ``sizes`` are the numbers of categories of the columns, ``ranges`` the numeric columns. ``blocks`` are the places of each
    column as ranges without their ends, ``numbers`` those of the numeric columns: columns in order and numbers last, unless
    states were merged, which adds a block for the categories that were new.
    """

    path: str
    columns: tuple[str, ...]
    sizes: tuple[int, ...]
    ranges: Mapping[str, tuple[float, float]]
    blocks: tuple[tuple[tuple[int, int], ...], ...] | None = None
    numbers: tuple[int, ...] | None = None

    def __post_init__(self):
        if self.blocks is None:
            object.__setattr__(self, "blocks", tuple((block,) for block in _blocks(self.sizes, 0)))
        if self.numbers is None:
            first = sum(self.sizes)
            object.__setattr__(self, "numbers", tuple(range(first, first + len(self.ranges))))

    @property
    def size(self) -> int:
        return sum(self.sizes) + len(self.ranges)

    def places(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(PLACES).parquet(f"{self.path}/places")


def _blocks(sizes: Sequence[int], start: int) -> list[tuple[int, int]]:
    """The places of columns with so many categories, one column after the other."""
    ends = list(accumulate(sizes, initial=start))
    return list(zip(ends, ends[1:]))


def fit_category_table(df: DataFrame, spec: FeatureSpec, path: str, on_bad: str = "error") -> CategoryTable:
    """Learn categories and ranges as :func:`strataflow.operators.features.fit` does, and keep the categories under ``path``."""
    spark = df.sparkSession
    ranges = fit_ranges(df, spec.numeric, on_bad)
    if not spec.categorical:
        return CategoryTable(path, (), (), ranges)
    pairs = category_pairs(df, spec.categorical).select(F.col("position").alias("column"), "category")
    placed, sizes = _in_places(pairs, len(spec.categorical), f"{path}/sorted", 0)
    if not sum(sizes):
        raise ValueError(f"no row is complete in {spec.categorical}")
    placed.write.parquet(f"{path}/places")
    return CategoryTable(path, spec.categorical, sizes, ranges)


def merge_category_tables(spark: SparkSession, old: CategoryTable, new: CategoryTable, path: str) -> CategoryTable:
    """One fitted state of two, kept under ``path``, as if fitted on the rows of both, which are not read again.

    What ``old`` placed keeps its place, numeric columns too; categories that only ``new`` has come after all of them,
    by column and category. So features made with ``old`` stay right, and merging the same state twice changes nothing.
    """
    if old.columns != new.columns or list(old.ranges) != list(new.ranges):
        raise ValueError("only states of the same columns can be merged")
    ranges = merge_ranges(old.ranges, new.ranges)
    if not old.columns:
        return CategoryTable(path, (), (), ranges)
    known = old.places(spark)
    fresh = new.places(spark).join(known, ["column", "category"], "left_anti").select("column", "category")
    placed, sizes = _in_places(fresh, len(old.columns), f"{path}/sorted", old.size)
    known.unionByName(placed).write.parquet(f"{path}/places")
    added = _blocks(sizes, old.size)
    return CategoryTable(
        path,
        old.columns,
        tuple(a + b for a, b in zip(old.sizes, sizes)),
        ranges,
        tuple((*blocks, block) if block[0] < block[1] else blocks for blocks, block in zip(old.blocks, added)),
        old.numbers,
    )


def _in_places(pairs: DataFrame, columns: int, path: str, first: int) -> tuple[DataFrame, tuple[int, ...]]:
    """(column, category, place) of distinct pairs in their order, places from ``first`` on, and the pairs of each column.

    They are sorted and stored under ``path``; a place is the number of a row in its file part and what the
    parts before it hold. Only the sizes of the parts come to the driver.
    """
    spark = pairs.sparkSession
    part, inner = F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")
    pairs.orderBy("column", "category").select("column", "category", part, inner).write.parquet(path)
    rows = spark.read.schema("column int, category string, part int, row bigint").parquet(path)
    found = rows.groupBy("part", "column").agg(F.count("*").alias("n")).collect()
    before, starts = first, []
    for number_of_part in sorted({r["part"] for r in found}):
        starts.append((number_of_part, before))
        before += sum(r["n"] for r in found if r["part"] == number_of_part)
    start = F.broadcast(spark.createDataFrame(starts, "part int, start bigint"))  # one row per file part
    place = F.col("start") + F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = tuple(sum(r["n"] for r in found if r["column"] == i) for i in range(columns))
    return rows.join(start, "part").select("column", "category", place.alias("place")), sizes


def sparse_features(
    df: DataFrame,
    fitted: CategoryTable,
    keep: Sequence[str],
    output: str = "features",
    on_unknown: str = "error",
    on_bad: str = "error",
    incomplete: str = "drop",
) -> DataFrame:
    """The ``keep`` columns and the features of each complete row as a struct (size, indices, values), zeros left out.

    Each category is looked up by a join with the fitted table: by broadcast where that has been counted small, else by key.
    One that was not fitted raises, or with ``on_unknown="ignore"`` gives zeros. With ``incomplete="encode"`` all rows stay:
    a missing category gives zeros, and a row that lacks a number has null features.
    """
    if incomplete not in ("drop", "encode"):
        raise ValueError(f"incomplete must be drop or encode, not {incomplete!r}")
    spark = df.sparkSession
    numeric = list(fitted.ranges)
    kept = [f"__keep_{i}" for i in range(len(keep))]
    if incomplete == "drop":
        df = df.filter(all_present(df.schema, list(fitted.columns)) & numbers_present(df.schema, numeric, on_bad))
    rows = df.select(
        *[column(c).alias(k) for c, k in zip(keep, kept)],
        *[column(c).cast("string").alias(f"__text_{i}") for i, c in enumerate(fitted.columns)],
        *[number(c, df.schema[c].dataType, on_bad).alias(f"__number_{i}") for i, c in enumerate(numeric)],
    )
    places = fitted.places(spark)
    for i, name in enumerate(fitted.columns):
        lookup = places.where(F.col("column") == i).select(F.col("category").alias(f"__text_{i}"), F.col("place").alias(f"__place_{i}"))
        if may_broadcast(lookup):
            rows = rows.join(F.broadcast(lookup), f"__text_{i}", "left")
        else:
            known = join_column(rows, lookup, [f"__text_{i}"], f"__place_{i}")
            unknown = rows.join(lookup, f"__text_{i}", "left_anti").withColumn(f"__place_{i}", F.lit(None).cast("bigint"))
            rows = known.unionByName(unknown)
        if on_unknown == "error":
            raised = F.raise_error(F.concat(F.lit(f"unknown category in {name}: "), F.col(f"__text_{i}")))
            known = F.col(f"__place_{i}").isNotNull() | F.col(f"__text_{i}").isNull()
            rows = rows.withColumn(f"__place_{i}", F.when(known, F.col(f"__place_{i}")).otherwise(raised.cast("bigint")))
    entries = [F.struct(F.col(f"__place_{i}").alias("i"), F.lit(1.0).alias("v")) for i in range(len(fitted.columns))]
    for i, (low, high) in enumerate(fitted.ranges.values()):
        width = high - low if high - low > 1e-15 else 1.0
        value = (F.col(f"__number_{i}") - F.lit(low)) / F.lit(width)
        entries.append(F.struct(F.lit(fitted.numbers[i]).cast("bigint").alias("i"), value.alias("v")))
    present = F.array_sort(F.filter(F.array(*entries), lambda e: e["i"].isNotNull() & (e["v"] != 0)))
    vector = F.struct(
        F.lit(fitted.size).cast("bigint").alias("size"),
        F.transform(present, lambda e: e["i"]).alias("indices"),
        F.transform(present, lambda e: e["v"]).alias("values"),
    )
    if incomplete == "encode" and numeric:
        numbers = [F.col(f"__number_{i}").isNotNull() for i in range(len(numeric))]
        vector = F.when(combine(operator.and_, numbers, F.lit(True)), vector)
    return rows.select(*[column(k).alias(c) for k, c in zip(kept, keep)], vector.alias(output))
