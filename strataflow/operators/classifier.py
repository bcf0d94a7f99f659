"""Logistic regression fitted by Spark ML and applied as column expressions."""

from __future__ import annotations

import operator
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.columns import column, combine

MAX_CLASSES = 1_000
"""Labels with more values are taken for a mistake, unless a fit is told otherwise: each class has a row of weights on the driver."""

ABOUT_SCHEMA = """label string, features array<string>, classes array<bigint>,
weights array<array<double>>, intercepts array<double>"""


@dataclass(frozen=True)
class LinearClassifier:
    """Weights of a fitted classifier.

    Two classes have one row of weights, whose margin is positive for the second class;
    more classes have one row each. ``vectors`` is the Spark ML model when the features
    were given as one vector column. ``iterations`` is known after a fit only.
    """

    label: str
    features: tuple[str, ...]
    classes: tuple[int, ...]
    weights: tuple[tuple[float, ...], ...]
    intercepts: tuple[float, ...]
    vectors: LogisticRegressionModel | None = field(default=None, compare=False)
    iterations: int | None = field(default=None, compare=False)

    def margin(self, row: int = 0) -> Column:
        """``intercept + sum(weight * feature)``, null if a feature is null."""
        terms = [F.lit(float(self.intercepts[row]))]
        terms += [F.lit(float(w)) * column(name) for w, name in zip(self.weights[row], self.features)]
        return combine(operator.add, terms, F.lit(0.0))

    def predicted_class(self) -> Column:
        """The predicted class as bigint, null if a feature is null. On a tie the first class wins."""
        return self.class_of([self.margin(row) for row in range(len(self.weights))])

    def class_of(self, margins: Sequence[Column]) -> Column:
        classes = [F.lit(c).cast("bigint") for c in self.classes]
        if len(classes) == 2:
            # null where the margin is null, and the margin is spelled out once only
            step = F.lit(self.classes[1] - self.classes[0]).cast("bigint")
            return classes[0] + step * (margins[0] > 0).cast("bigint")
        all_margins = F.array(*margins)
        place = F.array_position(all_margins, F.array_max(all_margins)).cast("int")
        return F.when(place > 0, F.element_at(F.array(*classes), place))

    def predict(self, df: DataFrame, output: str | None = None) -> DataFrame:
        """``df`` with the predicted class; a projection, so every row keeps its key."""
        return df.withColumn(output or self.label, self.predicted_class())

    def predict_vectors(self, df: DataFrame, features: str = "features", output: str | None = None) -> DataFrame:
        """As :meth:`predict`, for a vector column."""
        if self.vectors is None:
            raise ValueError("the classifier was not fitted on vectors")
        name = output or self.label
        classes = F.array(*[F.lit(c).cast("bigint") for c in self.classes])
        kept = [column(c) for c in df.columns if c != name]
        scored = self.vectors.setFeaturesCol(features).setPredictionCol("__place").transform(df)
        return scored.select(*kept, F.element_at(classes, F.col("__place").cast("int") + 1).alias(name))

    def save(self, spark: SparkSession, path: str) -> None:
        """Write under ``path``, which must not exist yet."""
        about = [
            (
                self.label,
                list(self.features),
                list(self.classes),
                [list(row) for row in self.weights],
                list(self.intercepts),
            )
        ]
        frame = spark.createDataFrame(about, ABOUT_SCHEMA).coalesce(1)
        frame.write.mode("errorifexists").parquet(f"{path}/weights")
        if self.vectors is not None:
            self.vectors.save(f"{path}/vectors")

    @classmethod
    def load(cls, spark: SparkSession, path: str, vectors: bool = False) -> LinearClassifier:
        row = spark.read.schema(ABOUT_SCHEMA).parquet(f"{path}/weights").first()
        return cls(
            row["label"],
            tuple(row["features"]),
            tuple(row["classes"]),
            tuple(tuple(weights) for weights in row["weights"]),
            tuple(row["intercepts"]),
            LogisticRegressionModel.load(f"{path}/vectors") if vectors else None,
        )


def split_target(df: DataFrame, label: str, ignore: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(features, target)`` of a training table, without the ``ignore`` columns."""
    return df.drop(label, *ignore), df.select(column(label))


def fit_logistic(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    vector: str | None = None,
    c: float = 1.0,
    max_iter: int = 100,
    tol: float = 1e-8,
    depth: int = 2,
    max_classes: int = MAX_CLASSES,
) -> LinearClassifier:
    """L2-regularised logistic regression that minimises ``c * loss + |w|^2 / 2``, intercept free.

    ``features`` are double columns, or the names of the entries of the ``vector`` column.
    Labels are whole numbers. One pass counts the rows of each class, then each iteration
    is one pass over the vectors, which Spark ML keeps in memory and on disk. ``depth`` is
    that of the tree in which gradients are summed: raise it for many tasks and features. Warns
    if ``max_iter`` iterations were not enough; the model has their number.
    """
    target = column(label).cast("bigint")
    counts = df.groupBy(target.alias("class")).count().limit(max_classes + 1).collect()
    if len(counts) > max_classes:
        raise ValueError(f"{label} has more than {max_classes} values: not a class label, or raise max_classes")
    if not counts:
        raise ValueError("no rows to fit")
    if any(row["class"] is None for row in counts):
        raise ValueError(f"{label} has missing values")
    classes = sorted(row["class"] for row in counts)
    if len(classes) < 2:
        raise ValueError(f"{label} has one class only: {classes}")
    place = F.array_position(F.array(*[F.lit(k).cast("bigint") for k in classes]), target) - 1
    rows = df.select(place.cast("double").alias("label"), *_vector_input(features, vector))
    if vector is None:
        names = [f"f{i}" for i in range(len(features))]
        rows = VectorAssembler(inputCols=names, outputCol="features").transform(rows).select("label", "features")
    model = LogisticRegression(
        regParam=1.0 / (c * sum(row["count"] for row in counts)),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=tol,
        aggregationDepth=depth,
    ).fit(rows)
    iterations = model.summary.totalIterations
    if iterations >= max_iter:
        warnings.warn(f"no convergence in {max_iter} iterations: raise max_iter or scale the features", stacklevel=2)
    weights = model.coefficientMatrix.toArray().tolist()
    return LinearClassifier(
        label,
        tuple(features),
        tuple(classes),
        tuple(tuple(row) for row in weights),
        tuple(model.interceptVector.toArray().tolist()),
        model if vector is not None else None,
        iterations,
    )


def _vector_input(features: Sequence[str], vector: str | None) -> list[Column]:
    if vector is not None:
        return [column(vector).alias("features")]
    return [column(name).alias(f"f{i}") for i, name in enumerate(features)]


def accuracy(df: DataFrame, label: str, prediction: str, output: str = "accuracy") -> DataFrame:
    """Share of rows whose prediction equals the label, as a one-row frame.

    A missing prediction is a miss, and so is any prediction where the label is missing.
    """
    hit = F.coalesce(column(prediction) == column(label), F.lit(False))
    return df.agg(F.avg(hit.cast("double")).alias(output))
