"""The jobs: ingest, features, training set, training, scoring."""

from strataflow.plans.jobs import (
    build_features,
    export_training_set,
    ingest_csv,
    save_training_set,
    score_by_join,
    score_in_place,
    train,
    training_set,
)
from strataflow.plans.scoring import (
    feature_rows,
    gold_by_join,
    gold_in_place,
    labelled_features,
    labelled_vectors,
    predictions,
)

__all__ = [
    "build_features",
    "export_training_set",
    "feature_rows",
    "gold_by_join",
    "gold_in_place",
    "ingest_csv",
    "labelled_features",
    "labelled_vectors",
    "predictions",
    "save_training_set",
    "score_by_join",
    "score_in_place",
    "train",
    "training_set",
]
