"""Logistic regression over any number of categories: the weights are a table, as the categories are, and never on the driver."""

from __future__ import annotations

import math
import operator
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.columns import column
from strataflow.operators.categories import CategoryTable
from strataflow.operators.joins import join_column, may_broadcast

MEMORY = 6
"""Pairs of steps and changes of the gradient from which a direction is made."""
#: Lengths of a step that are compared in one pass over the rows.
LENGTHS = tuple(2.0**k for k in range(-18, 4)) + (0.75, 1.5, 3.0)
WEIGHTS = "place bigint, weight double"


@dataclass(frozen=True)
class TableClassifier:
    """Weights under ``path`` by the places of a category table; the place after the last is the intercept.

    ``iterations`` is known after a fit, ``slope`` is the largest entry of the gradient there.
    """

    path: str
    label: str
    classes: tuple[int, int]
    iterations: int
    slope: float

    def weights(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(WEIGHTS).parquet(f"{self.path}/weights")

    def margins(self, df: DataFrame, fitted: CategoryTable, keep: Sequence[str], features: str = "features", output: str = "margin") -> DataFrame:
        """The ``keep`` columns and the margin of each row of sparse features, positive for the second class.

        Categories that were not fitted count as zero.
        """
        names = [f"__keep_{i}" for i in range(len(keep))]
        rows = df.select(*(column(c).alias(n) for c, n in zip(keep, names)), *_parts(fitted, features))
        scored = _with_product(rows, self.weights(df.sparkSession), "weight", fitted, "__margin")
        return scored.select(*(F.col(n).alias(c) for c, n in zip(keep, names)), F.col("__margin").alias(output))

    def predict(self, df: DataFrame, fitted: CategoryTable, keep: Sequence[str], features: str = "features") -> DataFrame:
        """The ``keep`` columns and the predicted class as the label, the first class on a tie."""
        scored = self.margins(df, fitted, keep, features, "__score")
        low, high = (F.lit(c).cast("bigint") for c in self.classes)
        return scored.select(*(column(c) for c in keep), F.when(F.col("__score") > 0, high).otherwise(low).alias(self.label))


def fit_table_logistic(
    df: DataFrame, label: str, fitted: CategoryTable, path: str, features: str = "features", c: float = 1.0, max_iter: int = 100, tol: float = 1e-6
) -> TableClassifier:
    """Minimise ``c * loss + |w|^2 / 2`` with a free intercept, as ``fit_logistic`` does, for two classes.

    ``df`` has the label and sparse features of ``fitted``; missing labels, and more or fewer than two classes, raise. Weights, gradient and the
    last steps are columns of a table with a row per place. An iteration looks up the weights of a row by joins
    on its places (by broadcast where the table has been counted small, else salted for frequent categories), compares lengths of
    the step in one pass, and sums the gradient by place before the shuffle. To the driver come products of those columns, and
    the entries of numeric columns and the intercept. It ends where no entry of the gradient is over ``tol`` times the
    number of rows, or no step makes the loss smaller.

    Each iteration is stored under ``path``, which must not exist yet, so what follows does not depend on executors that were lost.
    """
    spark = df.sparkSession
    target = column(label).cast("bigint")
    counts = df.groupBy(target.alias("class")).count().limit(3).collect()
    if len(counts) != 2 or any(r["class"] is None for r in counts):
        raise ValueError(f"{label} must have two classes and no missing values")
    classes, total = sorted(r["class"] for r in counts), sum(r["count"] for r in counts)
    zero = F.lit(0.0)
    rows = df.select((target == classes[1]).cast("double").alias("y"), *_parts(fitted, features), zero.alias("margin"), zero.alias("along"))
    rows = _stored(rows, f"{path}/rows-0")
    free = fitted.size  # the place of the intercept
    state = spark.range(free + 1).select(F.col("id").alias("place"), zero.alias("weight"))
    history = [f"{kind}{i}" for kind in "sy" for i in range(MEMORY)]
    state = state.select("*", *(zero.alias(h) for h in history), zero.alias("step"))
    slopes = _gradient(rows, fitted, c)
    state = state.join(slopes, "place", "left").withColumn("gradient", F.coalesce("gradient", zero))
    state = _stored(state, f"{path}/state-0")

    pairs, done = 0, 0
    while True:
        products = _products(state, [*history, "gradient"], free)
        slope = products.pop("slope")
        if slope <= tol * total or done >= max_iter:
            break
        parts = _direction(products["matrix"], pairs)
        step = sum((F.lit(float(x)) * F.col(h) for x, h in zip(parts, [*history, "gradient"]) if x), zero)
        state = state.withColumn("step", step)
        moved = _with_product(rows.drop("along"), state.select("place", "step"), "step", fitted, "along")
        rows = _stored(moved, f"{path}/rows-{done + 1}")
        own = F.col("place") < free
        ww, wd, dd = state.where(own).agg(*(F.coalesce(F.sum(F.col(a) * F.col(b)), zero) for a, b in (("weight", "weight"), ("weight", "step"), ("step", "step")))).first()
        losses = rows.agg(*(F.sum(_loss(F.col("margin") + t * F.col("along"), F.col("y"))) for t in (0.0, *LENGTHS))).first()
        value = {t: c * loss + (ww + 2 * t * wd + t * t * dd) / 2 for t, loss in zip((0.0, *LENGTHS), losses)}
        best = min(value, key=value.get)
        if best == 0.0:
            break  # as far as the precision of the sums goes
        rows = rows.withColumn("margin", F.col("margin") + best * F.col("along"))
        shifted = {f"{kind}{i}": F.col(f"{kind}{i + 1}") for kind in "sy" for i in range(MEMORY - 1)}
        weight = F.col("weight") + best * F.col("step")
        new = F.coalesce("sum", zero) + F.when(own, weight).otherwise(0.0)
        shifted |= {f"s{MEMORY - 1}": best * F.col("step"), f"y{MEMORY - 1}": new - F.col("gradient")}
        slopes = _gradient(rows, fitted, c).withColumnRenamed("gradient", "sum")
        state = state.join(slopes, "place", "left").select("place", weight.alias("weight"), *(shifted[h].alias(h) for h in history), zero.alias("step"), new.alias("gradient"))
        done += 1
        state = _stored(state, f"{path}/state-{done}")
        pairs = min(pairs + 1, MEMORY)
    if slope > tol * total:
        warnings.warn(f"the gradient is still {slope:g} after {done} iterations", stacklevel=2)
    state.select("place", "weight").write.parquet(f"{path}/weights")
    return TableClassifier(path, label, (classes[0], classes[1]), done, slope)


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _parts(fitted: CategoryTable, features: str) -> list[Column]:
    """The place of each categorical column (null without one) and the value of each numeric one, from sparse features."""
    indices, values = F.col(f"`{features}`.indices"), F.col(f"`{features}`.values")
    out = []
    for i, blocks in enumerate(fitted.blocks):
        out.append(F.get(F.filter(indices, _within(blocks)), F.lit(0)).alias(f"p{i}"))
    for i, place in enumerate(fitted.numbers):
        at = F.array_position(indices, F.lit(place).cast("bigint"))
        out.append(F.coalesce(F.get(values, (at - 1).cast("int")), F.lit(0.0)).alias(f"x{i}"))
    return out


def _within(blocks: Sequence[tuple[int, int]]) -> Callable[[Column], Column]:
    return lambda place: reduce(operator.or_, [(place >= start) & (place < end) for start, end in blocks])


def _with_product(rows: DataFrame, table: DataFrame, value: str, fitted: CategoryTable, output: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the places of a row, each times the row's value there."""
    few = [*fitted.numbers, fitted.size]  # numeric columns and the intercept
    dense = {r["place"]: r[value] for r in table.where(F.col("place").isin(few)).collect()}
    total = F.lit(float(dense[fitted.size]))
    for i, place in enumerate(fitted.numbers):
        total = total + F.lit(float(dense[place])) * F.col(f"x{i}")
    kept = rows.columns
    for i, blocks in enumerate(fitted.blocks):
        lookup = table.where(_within(blocks)(F.col("place"))).select(F.col("place").alias(f"p{i}"), F.col(value).alias(f"__w{i}"))
        if may_broadcast(lookup):
            rows = rows.join(F.broadcast(lookup), f"p{i}", "left")
        else:
            found = join_column(rows.where(F.col(f"p{i}").isNotNull()), lookup, [f"p{i}"], f"__w{i}")
            rows = found.unionByName(rows.where(F.col(f"p{i}").isNull()).withColumn(f"__w{i}", F.lit(0.0)))
        total = total + F.coalesce(F.col(f"__w{i}"), F.lit(0.0))
    return rows.select(*kept, total.alias(output))


def _gradient(rows: DataFrame, fitted: CategoryTable, c: float) -> DataFrame:
    """(place, gradient) of the loss, for places that some row has."""
    error = c * (1 / (1 + F.exp(-F.col("margin"))) - F.col("y"))
    entries = [(F.col(f"p{i}"), F.lit(1.0)) for i in range(len(fitted.sizes))]
    entries += [(F.lit(place).cast("bigint"), F.col(f"x{i}")) for i, place in enumerate(fitted.numbers)]
    entries.append((F.lit(fitted.size).cast("bigint"), F.lit(1.0)))
    each = rows.select(error.alias("error"), *(f"p{i}" for i in range(len(fitted.sizes))), *(f"x{i}" for i in range(len(fitted.ranges))))
    each = each.select(F.explode(F.array(*(F.struct(p.alias("place"), (v * F.col("error")).alias("v")) for p, v in entries))).alias("e"))
    return each.where("e.place is not null").groupBy(F.col("e.place").alias("place")).agg(F.sum("e.v").alias("gradient"))


def _loss(margin: Column, y: Column) -> Column:
    return F.greatest(margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin))) - y * margin


def _products(state: DataFrame, names: list[str], free: int) -> dict:
    """Products of all pairs of columns, and the largest entry of the gradient."""
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    row = state.agg(*(F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs), F.max(F.abs("gradient"))).first()
    matrix = np.zeros((len(names), len(names)))
    for (i, j), value in zip(pairs, row):
        matrix[i, j] = matrix[j, i] = value
    return {"matrix": matrix, "slope": float(row[len(pairs)])}


def _direction(matrix: np.ndarray, pairs: int) -> np.ndarray:
    """The L-BFGS direction as a combination of steps, changes and the gradient, from their products alone (Chen et al. 2014)."""
    out = np.zeros(2 * MEMORY + 1)
    out[-1] = -1.0
    used = [i for i in range(MEMORY - pairs, MEMORY) if matrix[i, MEMORY + i] > 0]
    if not used:
        return out / max(1.0, math.sqrt(matrix[-1, -1]))
    share = {}
    for i in reversed(used):
        share[i] = out @ matrix[:, i] / matrix[i, MEMORY + i]
        out[MEMORY + i] -= share[i]
    last = used[-1]
    out *= matrix[last, MEMORY + last] / matrix[MEMORY + last, MEMORY + last]
    for i in used:
        out[i] += share[i] - out @ matrix[:, MEMORY + i] / matrix[i, MEMORY + i]
    return out
