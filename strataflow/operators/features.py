"""One-hot and min-max features, fitted on complete rows and applied row by row.

Fitting is one aggregate per column group. Only fitted values reach the driver, and the
number of categories among them is checked. Applying is a projection without a shuffle, so
a row keeps its key.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.columns import (
    all_present,
    check_names,
    column,
    complete_rows,
    feature_name,
    number,
    numbers_present,
    quoted,
)
from strataflow.spec import FeatureSpec

WIDE_LIMIT = 1_000
"""Categories, over all columns, up to which each one may become a column."""

LISTED_CATEGORIES = 32
"""Categories of a column up to which a value is looked up in a list, beyond by a join with the fitted ones."""

CATEGORY_SCHEMA = "column string, position int, category string, feature string"
RANGE_SCHEMA = "column string, position int, minimum double, maximum double"


@dataclass(frozen=True)
class Preparation:
    """Fitted state: sorted categories and value range of each column, in column order."""

    categories: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)

    @property
    def category_rows(self) -> list[tuple[str, int, str, str]]:
        return [
            (name, position, category, feature_name(name, category))
            for name, values in self.categories.items()
            for position, category in enumerate(values)
        ]

    @property
    def feature_names(self) -> list[str]:
        return [row[3] for row in self.category_rows] + list(self.ranges)

    def category_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.category_rows, CATEGORY_SCHEMA)

    def range_table(self, spark: SparkSession) -> DataFrame:
        rows = [(name, i, low, high) for i, (name, (low, high)) in enumerate(self.ranges.items())]
        return spark.createDataFrame(rows, RANGE_SCHEMA)


def category_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct ``(position, category)`` of the columns over rows complete in all of them.

    The columns are unpivoted and made distinct per task before the shuffle, so a category
    that fills a third of the table crosses it once per task.
    """
    complete = complete_rows(df, columns)
    texts = [column(name).cast("string").alias(str(i)) for i, name in enumerate(columns)]
    long = complete.select(texts).unpivot([], [str(i) for i in range(len(columns))], "position", "category")
    return long.select(F.col("position").cast("int"), "category").distinct()


def fit_categories(df: DataFrame, columns: Sequence[str], limit: int = WIDE_LIMIT) -> dict[str, tuple[str, ...]]:
    """Sorted categories of each column; raises if there are more than ``limit`` in all."""
    if not columns:
        return {}
    found = category_pairs(df, columns).limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {limit} categories in {tuple(columns)}: use fit_category_table, or raise the limit")
    if not found:
        raise ValueError(f"no row is complete in {tuple(columns)}")
    return {
        name: tuple(sorted(row["category"] for row in found if row["position"] == i))
        for i, name in enumerate(columns)
    }


def fit_ranges(df: DataFrame, columns: Sequence[str], on_bad: str = "error") -> dict[str, tuple[float, float]]:
    """Minimum and maximum of each column over rows complete in all of them, in one pass."""
    if not columns:
        return {}
    present = df.filter(numbers_present(df.schema, columns, on_bad))
    numbers = present.select([number(c, df.schema[c].dataType, on_bad).alias(c) for c in columns])
    bounds = [f(column(name)).alias(f"{kind}{i}") for i, name in enumerate(columns) for kind, f in _BOUNDS.items()]
    found = numbers.agg(*bounds).first()
    if found["low0"] is None:
        raise ValueError(f"no row is complete in {tuple(columns)}")
    return {name: (found[f"low{i}"], found[f"high{i}"]) for i, name in enumerate(columns)}


_BOUNDS = {"low": F.min, "high": F.max}


def fit(df: DataFrame, spec: FeatureSpec, limit: int = WIDE_LIMIT, on_bad: str = "error") -> Preparation:
    """Learn categories and ranges. Each group of columns has its own complete rows."""
    preparation = Preparation(
        fit_categories(df, spec.categorical, limit),
        fit_ranges(df, spec.numeric, on_bad),
    )
    check_names(preparation.feature_names)
    return preparation


def merge_ranges(
    old: Mapping[str, tuple[float, float]], new: Mapping[str, tuple[float, float]]
) -> dict[str, tuple[float, float]]:
    """The ranges of all rows from those of two parts."""
    return {name: (min(low, new[name][0]), max(high, new[name][1])) for name, (low, high) in old.items()}


def merge_preparations(old: Preparation, new: Preparation) -> Preparation:
    """One fitted state of two, as if fitted on the rows of both; categories that only ``new`` has come last in their column.

    Merging the same state again changes nothing.
    """
    if list(old.categories) != list(new.categories) or list(old.ranges) != list(new.ranges):
        raise ValueError("only states of the same columns can be merged")
    categories = {
        name: (*values, *sorted(set(new.categories[name]) - set(values))) for name, values in old.categories.items()
    }
    preparation = Preparation(categories, merge_ranges(old.ranges, new.ranges))
    check_names(preparation.feature_names)
    return preparation


def transform(
    df: DataFrame,
    preparation: Preparation,
    keep: Sequence[str | Column] = (),
    on_unknown: str = "error",
    incomplete: str = "null",
    on_bad: str = "error",
) -> DataFrame:
    """The ``keep`` columns and one double per feature, row by row.

    A category that was not fitted raises, or with ``on_unknown="ignore"`` gives zeros.
    With ``incomplete="null"`` a row that lacks a value of a group has nulls in that whole
    group; with ``"encode"`` each column stands alone, a missing category giving zeros and
    a missing number null.
    """
    rows, names = coded_rows(df, preparation, keep, on_unknown, incomplete, on_bad)
    check_names([*names, *preparation.feature_names])
    return rows.select(
        *map(column, names),
        *_one_hot(preparation),
        *[F.col(scaled_name(i)).alias(name) for i, name in enumerate(preparation.ranges)],
    )


def place_name(i: int) -> str:
    return f"__place_{i}"


def scaled_name(i: int) -> str:
    return f"__scaled_{i}"


def coded_rows(
    df: DataFrame,
    preparation: Preparation,
    keep: Sequence[str | Column] = (),
    on_unknown: str = "error",
    incomplete: str = "null",
    on_bad: str = "error",
) -> tuple[DataFrame, list[str]]:
    """The kept columns and two kinds of columns from which features or scores are made, with the names of the former.

    ``place_name(i)`` is the place of the i-th column's category among the fitted ones,
    counted from 1, or 0 for a category that gives zeros; ``scaled_name(i)`` is the i-th
    number, scaled. A category is looked up once however many features it has: comparing
    text in every feature makes a method too long for the JVM to compile.
    """
    rows, names = _checked(df, preparation, keep, on_unknown, incomplete, on_bad)
    texts = range(len(preparation.categories))
    places = []
    for i, values in enumerate(preparation.categories.values()):
        text = F.col(f"__text_{i}")
        if len(values) <= LISTED_CATEGORIES:
            places.append(F.array_position(F.array(*map(F.lit, values)), text).cast("int"))
            continue
        # a list is searched from its start for every row; these rows are those of the fitted state
        listed = [(value, j + 1) for j, value in enumerate(values)]
        lookup = df.sparkSession.createDataFrame(listed, f"__category_{i} string, __at_{i} int")
        rows = rows.join(F.broadcast(lookup), F.col(f"__category_{i}") == text, "left")
        places.append(F.when(text.isNotNull(), F.coalesce(F.col(f"__at_{i}"), F.lit(0))))
    found = rows.select(
        *map(column, names),
        *[F.col(f"__text_{i}") for i in texts if on_unknown == "error"],
        *[place.alias(place_name(i)) for i, place in enumerate(places)],
        *[value.alias(scaled_name(i)) for i, value in enumerate(_min_max(preparation))],
    )
    checked = []
    for i, name in enumerate(preparation.categories):
        place = F.col(place_name(i))
        if on_unknown == "error":
            place = F.when(place == 0, _unknown_category(name, F.col(f"__text_{i}"))).otherwise(place)
        if incomplete == "encode":
            place = F.coalesce(place, F.lit(0))
        checked.append(place.alias(place_name(i)))
    scaled = [F.col(scaled_name(i)) for i in range(len(preparation.ranges))]
    return found.select(*map(column, names), *checked, *scaled), names


def _checked(
    df: DataFrame,
    preparation: Preparation,
    keep: Sequence[str | Column],
    on_unknown: str,
    incomplete: str,
    on_bad: str,
) -> tuple[DataFrame, list[str]]:
    """The kept columns, then each source column as text or number, null where its group is incomplete."""
    if on_unknown not in ("error", "ignore"):
        raise ValueError(f"on_unknown must be 'error' or 'ignore', not {on_unknown!r}")
    if incomplete not in ("null", "encode"):
        raise ValueError(f"incomplete must be 'null' or 'encode', not {incomplete!r}")
    categorical, numeric = list(preparation.categories), list(preparation.ranges)
    types = [df.schema[name].dataType for name in numeric]
    texts, numbers = (
        [f"__{p}_{i}" for i in range(n)] for p, n in (("text", len(categorical)), ("number", len(numeric)))
    )
    rows = df.select(
        *[column(c) if isinstance(c, str) else c for c in keep],
        *[column(c).cast("string").alias(text) for c, text in zip(categorical, texts)],
        *[column(c).alias(value) for c, value in zip(numeric, numbers)],
        all_present(df.schema, categorical).alias("__texts"),
        numbers_present(df.schema, numeric, on_bad).alias("__numbers"),
    )
    names = rows.columns[: len(keep)]
    text = {name: F.col(name) for name in texts}
    value = {name: number(name, kind, on_bad, shown) for name, kind, shown in zip(numbers, types, numeric)}
    if incomplete == "null":
        text = {name: F.when(F.col("__texts"), c) for name, c in text.items()}
        value = {name: F.when(F.col("__numbers"), c) for name, c in value.items()}
    checked = [c.alias(name) for name, c in (text | value).items()]
    return rows.select(*map(column, names), *checked), names


def _unknown_category(name: str, text: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"unknown category in {name}: "), text))


def _one_hot(preparation: Preparation) -> list[Column]:
    return [
        F.expr(f"CAST({place_name(i)} = {j + 1} AS DOUBLE) AS {quoted(feature_name(name, category))}")
        for i, (name, categories) in enumerate(preparation.categories.items())
        for j, category in enumerate(categories)
    ]


def _min_max(preparation: Preparation) -> list[Column]:
    """Values outside the fitted range are not clipped; a constant column becomes its distance to the constant."""
    features = []
    for i, (low, high) in enumerate(preparation.ranges.values()):
        width = high - low
        if width < 10 * sys.float_info.epsilon:
            width = 1.0
        features.append((F.col(f"__number_{i}") - F.lit(low)) / F.lit(width))
    return features


def to_vectors(
    df: DataFrame,
    preparation: Preparation,
    keep: Sequence[str] = (),
    output: str = "features",
    on_unknown: str = "error",
    incomplete: str = "null",
    on_bad: str = "error",
) -> DataFrame:
    """Like :func:`transform`, but one sparse vector per row, for many categories.

    Rows without a value for some number, or (with ``incomplete="null"``) for some
    category, have no vector and are left out. The order of the vector's entries is
    ``preparation.feature_names``.
    """
    # categories are looked up in the indexer's hash table, not in an expression
    rows, kept = _checked(df, preparation, keep, "ignore", incomplete, on_bad)
    texts, numbers = ([c for c in rows.columns[len(kept) :] if c.startswith(p)] for p in ("__text_", "__number_"))
    rows = complete_rows(rows, numbers + texts if incomplete == "null" else numbers)
    blocks = []
    if texts:
        indexes, blocks = ([f"__{p}_{i}" for i in range(len(texts))] for p in ("index", "block"))
        # an unknown or missing category gets the extra last index, which dropLast turns into zeros
        for (name, values), text, index in zip(preparation.categories.items(), texts, indexes):
            indexer = StringIndexerModel.from_labels(list(values), text, index, handleInvalid="keep")
            rows = indexer.transform(rows)
            if on_unknown == "error":
                unknown = F.col(text).isNotNull() & (F.col(index) == len(values))
                known = F.when(unknown, _unknown_category(name, F.col(text))).otherwise(F.lit(True))
                rows = rows.filter(known)
        rows = OneHotEncoder(inputCols=indexes, outputCols=blocks, dropLast=True).fit(rows).transform(rows)
    scaled = [scaled_name(i) for i in range(len(numbers))]
    minmax = [value.alias(name) for value, name in zip(_min_max(preparation), scaled)]
    rows = rows.select(*map(column, kept), *blocks, *minmax)
    assembled = VectorAssembler(inputCols=[*blocks, *scaled], outputCol=output).transform(rows)
    return assembled.select(*map(column, kept), output)


def save_preparation(spark: SparkSession, preparation: Preparation, path: str) -> None:
    """Write the fitted state as two small tables under ``path``, replacing what is there."""
    preparation.category_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/categories")
    preparation.range_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/ranges")


def load_preparation(spark: SparkSession, path: str, spec: FeatureSpec) -> Preparation:
    """Read what :func:`save_preparation` wrote, for the columns of ``spec``."""
    categories: dict[str, list[tuple[int, str]]] = {name: [] for name in spec.categorical}
    for row in spark.read.schema(CATEGORY_SCHEMA).parquet(f"{path}/categories").collect():
        categories[row["column"]].append((row["position"], row["category"]))
    ranges = {row["column"]: row for row in spark.read.schema(RANGE_SCHEMA).parquet(f"{path}/ranges").collect()}
    return Preparation(
        {name: tuple(category for _, category in sorted(rows)) for name, rows in categories.items()},
        {name: (ranges[name]["minimum"], ranges[name]["maximum"]) for name in spec.numeric},
    )
