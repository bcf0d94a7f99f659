"""From raw or feature rows to predictions, as frames without side effects."""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.columns import (
    check_names,
    column,
    combine,
    complete_rows,
    feature_name,
    numbers_present,
)
from strataflow.operators.classifier import LinearClassifier
from strataflow.operators.features import Preparation, coded_rows, place_name, scaled_name, to_vectors, transform
from strataflow.operators.joins import complete_keys, join_column
from strataflow.spec import FeatureSpec


def feature_rows(bronze: DataFrame, preparation: Preparation, spec: FeatureSpec, **options) -> DataFrame:
    """Silver: the keys and the features of each raw row."""
    return transform(bronze, preparation, spec.keys, **options)


def labelled_features(
    bronze: DataFrame,
    labels: DataFrame,
    preparation: Preparation,
    spec: FeatureSpec,
    key: str,
    handle_frequent: bool = True,
    **options,
) -> DataFrame:
    """The training rows of raw rows and a label table: keys, features, label.

    Equal to joining silver with the labels, but the raw rows are what is shuffled, which
    are several times narrower than one double per category.
    """
    joined = _labelled(bronze, labels, spec, key, handle_frequent)
    features = transform(joined, preparation, [*spec.keys, column(spec.label).alias("__label")], **options)
    return features.select(
        *map(column, [*spec.keys, *preparation.feature_names]), F.col("__label").alias(spec.label)
    )


def labelled_vectors(
    bronze: DataFrame,
    labels: DataFrame,
    preparation: Preparation,
    spec: FeatureSpec,
    key: str,
    handle_frequent: bool = True,
    **options,
) -> DataFrame:
    """As :func:`labelled_features`, the features as one sparse vector, and only rows that have all of them."""
    joined = _labelled(bronze, labels, spec, key, handle_frequent)
    return to_vectors(joined, preparation, [*spec.keys, spec.label], **options)


def _labelled(
    bronze: DataFrame, labels: DataFrame, spec: FeatureSpec, key: str, handle_frequent: bool
) -> DataFrame:
    rows = bronze.select(*map(column, dict.fromkeys([key, *spec.keys, *spec.categorical, *spec.numeric])))
    return join_column(rows, labels, [key], spec.label, handle_frequent=handle_frequent)


def predictions(silver: DataFrame, model: LinearClassifier, spec: FeatureSpec) -> DataFrame:
    """Keys and predicted class of the feature rows that have every value."""
    complete = complete_rows(silver)
    return complete.select(*map(column, spec.keys), model.predicted_class().alias(model.label))


def gold_by_join(
    bronze: DataFrame, silver: DataFrame, model: LinearClassifier, spec: FeatureSpec, **options
) -> DataFrame:
    """Raw rows with the class predicted for their keys; rows without a prediction are left out.

    An inner join, so a key that occurs twice on both sides gives four rows. For tables
    whose feature rows come from the same raw rows :func:`gold_in_place` gives each row its
    own prediction and needs no join. ``options`` are those of :func:`join_column`.
    """
    check_names([*bronze.columns, model.label])
    found = predictions(silver, model, spec)
    return join_column(bronze, found, spec.keys, model.label, key_frames=(bronze, silver), **options)


def gold_in_place(
    bronze: DataFrame,
    preparation: Preparation,
    model: LinearClassifier,
    spec: FeatureSpec,
    on_unknown: str = "error",
    incomplete: str = "null",
    on_bad: str = "error",
) -> DataFrame:
    """As :func:`gold_by_join` where keys are unique, without a shuffle: one projection of the raw rows.

    With ``incomplete="encode"`` only numbers are needed for a prediction, as in a stream.
    """
    check_names([*bronze.columns, model.label])
    unknown = set(model.features) - set(preparation.feature_names)
    if unknown:
        raise ValueError(f"the model has features that are not prepared: {sorted(unknown)}")
    # filters on the raw columns reach the scan, a filter on the prediction would score every row twice
    rows = complete_keys(bronze, spec.keys).filter(numbers_present(bronze.schema, list(preparation.ranges), on_bad))
    if incomplete == "null":
        rows = complete_rows(rows, list(preparation.categories))
    # the raw columns go by name, so that those nobody asks for are not read
    coded, names = coded_rows(rows, preparation, bronze.columns, on_unknown, incomplete, on_bad)
    margins = [_coded_margin(preparation, model, row) for row in range(len(model.weights))]
    return coded.select(*map(column, names), model.class_of(margins).alias(model.label))


def _coded_margin(preparation: Preparation, model: LinearClassifier, row: int) -> Column:
    """The margin from the places of categories: one weight is looked up per column, no feature is built."""
    weight = dict(zip(model.features, model.weights[row]))
    terms = [F.lit(float(model.intercepts[row]))]
    for i, (name, values) in enumerate(preparation.categories.items()):
        weights = [0.0, *(float(weight.get(feature_name(name, v), 0.0)) for v in values)]
        terms.append(F.get(F.array(*map(F.lit, weights)), F.col(place_name(i))))
    for i, name in enumerate(preparation.ranges):
        terms.append(F.lit(float(weight.get(name, 0.0))) * F.col(scaled_name(i)))
    return combine(operator.add, terms, F.lit(0.0))
