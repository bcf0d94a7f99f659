"""Batch jobs over the layer tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strataflow.functions.columns import complete_rows
from strataflow.operators.classifier import LinearClassifier, accuracy, fit_logistic
from strataflow.operators.features import WIDE_LIMIT, Preparation, fit, save_preparation
from strataflow.operators.joins import join_column
from strataflow.operators.registry import Registry
from strataflow.operators.split import hash_split
from strataflow.plans.scoring import feature_rows, gold_by_join, gold_in_place, labelled_features, labelled_vectors
from strataflow.session import short_methods
from strataflow.sources.catalog import create_database, create_table, create_table_like, overwrite, read_table
from strataflow.sources.files import export_csv, read_csv
from strataflow.spec import FeatureSpec, Layers


def ingest_csv(
    spark: SparkSession, path: str | list[str], layers: Layers, columns: list[str] | None = None, **options
) -> None:
    """Load CSV files as text into bronze, replacing it. ``columns`` fixes the columns and saves reading the header first."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]) if columns else None
    rows = read_csv(spark, path, schema, **options)
    create_database(spark, layers.database)
    create_table(spark, layers.table("bronze"), rows.schema, layers.fmt)
    overwrite(rows, layers.table("bronze"), layers.fmt)


def build_features(
    spark: SparkSession,
    layers: Layers,
    spec: FeatureSpec,
    preparation_path: str | None = None,
    limit: int = WIDE_LIMIT,
    on_bad: str = "error",
) -> Preparation:
    """Fit features on bronze, save them under ``preparation_path``, and replace silver by the feature rows."""
    bronze = read_table(spark, layers.table("bronze"))
    preparation = fit(bronze, spec, limit, on_bad)
    if preparation_path:
        save_preparation(spark, preparation, preparation_path)
    silver = feature_rows(bronze, preparation, spec, on_bad=on_bad)
    _replace(silver, layers, "silver")
    return preparation


def training_set(silver: DataFrame, labels: DataFrame, key: str, label: str, handle_frequent: bool = True) -> DataFrame:
    """Feature rows with the label of their key."""
    return join_column(silver, labels, [key], label, handle_frequent=handle_frequent)


def export_training_set(
    spark: SparkSession,
    layers: Layers,
    labels_path: str,
    spec: FeatureSpec,
    preparation: Preparation,
    key: str,
    path: str,
    single_file: bool = False,
) -> None:
    """Join bronze with a label CSV and write keys, features and label as CSV."""
    labels = read_csv(spark, labels_path)
    rows = labelled_features(read_table(spark, layers.table("bronze")), labels, preparation, spec, key)
    with short_methods(spark):
        export_csv(rows, path, single_file)


def save_training_set(
    spark: SparkSession,
    layers: Layers,
    labels: DataFrame,
    spec: FeatureSpec,
    preparation: Preparation,
    key: str,
    table: str,
    vectors: bool = False,
    **options,
) -> None:
    """Join bronze with labels and write the features as a table, or with ``vectors`` as one sparse column.

    Training reads its rows several times, so they should be stored and not a join that is
    run again each time. The table keeps types and is read by column, which CSV is not.
    Sparse vectors are written and read several times faster than a column per category.
    """
    bronze = read_table(spark, layers.table("bronze"))
    make = labelled_vectors if vectors else labelled_features
    rows = make(bronze, labels, preparation, spec, key, **options)
    with short_methods(spark):
        overwrite(rows, table, layers.fmt)


@dataclass(frozen=True)
class Trained:
    model: LinearClassifier
    accuracy: float
    run_id: str
    version: int


def train(
    spark: SparkSession,
    rows: DataFrame,
    spec: FeatureSpec,
    registry: Registry,
    name: str,
    experiment: str = "default",
    test_size: float = 0.2,
    seed: int = 42,
    features: Sequence[str] | None = None,
    vector: str | None = None,
    **options,
) -> Trained:
    """Fit on complete rows outside the held-out part, log the accuracy on that part, register the model.

    ``rows`` are read several times: a table or files, not a join. All columns besides keys
    and label are features, unless they are in one ``vector`` column: then ``features``
    names its entries, as in ``preparation.feature_names``.
    """
    if vector and not features:
        raise ValueError("the features of the vector need names")
    features = features or [c for c in rows.columns if c not in spec.keys and c != spec.label]
    kept, held_out = hash_split(complete_rows(rows), spec.keys, test_size, seed)
    with short_methods(spark):
        model = fit_logistic(kept, spec.label, features, vector, **options)
        found = model.predict_vectors(held_out, vector, "__class") if vector else model.predict(held_out, "__class")
        share = accuracy(found, spec.label, "__class").first()["accuracy"]
    if share is None:
        raise ValueError("no rows were held out")
    registry.create(spark)
    run_id = registry.log_metric(spark, experiment, name, "accuracy", share)
    return Trained(model, share, run_id, registry.register(spark, model, name, run_id))


def score_by_join(
    spark: SparkSession, layers: Layers, spec: FeatureSpec, registry: Registry, name: str, version: int = 1
) -> None:
    """Predict for silver with a registered model and replace gold by bronze joined with the predictions."""
    model = registry.load(spark, name, version)
    bronze, silver = (read_table(spark, layers.table(layer)) for layer in ("bronze", "silver"))
    with short_methods(spark):
        gold = gold_by_join(bronze, silver, model, spec)
    _replace(gold, layers, "gold")


def score_in_place(
    spark: SparkSession,
    layers: Layers,
    spec: FeatureSpec,
    preparation: Preparation,
    registry: Registry,
    name: str,
    version: int = 1,
    **options,
) -> None:
    """As :func:`score_by_join` for unique keys, from bronze alone and without a shuffle."""
    model = registry.load(spark, name, version)
    bronze = read_table(spark, layers.table("bronze"))
    _replace(gold_in_place(bronze, preparation, model, spec, **options), layers, "gold")


def _replace(df: DataFrame, layers: Layers, layer: str) -> None:
    create_table_like(df, layers.table(layer), layers.fmt)
    with short_methods(df.sparkSession):
        overwrite(df, layers.table(layer), layers.fmt)
