"""Fitted features, key joins, the hash split, the classifier and its registry."""

from strataflow.operators.categories import CategoryTable, fit_category_table, merge_category_tables, sparse_features
from strataflow.operators.classifier import LinearClassifier, accuracy, fit_logistic, split_target
from strataflow.operators.features import (
    Preparation,
    category_pairs,
    fit,
    fit_categories,
    fit_ranges,
    load_preparation,
    merge_preparations,
    save_preparation,
    to_vectors,
    transform,
)
from strataflow.operators.joins import join_column, join_on_keys, may_broadcast, sketch_keys
from strataflow.operators.registry import Registry
from strataflow.operators.split import hash_bucket, hash_split
from strataflow.operators.table_classifier import TableClassifier, fit_table_logistic

__all__ = [
    "CategoryTable",
    "fit_category_table",
    "sparse_features",
    "LinearClassifier",
    "Preparation",
    "Registry",
    "TableClassifier",
    "accuracy",
    "category_pairs",
    "fit",
    "fit_categories",
    "fit_logistic",
    "fit_ranges",
    "fit_table_logistic",
    "hash_bucket",
    "hash_split",
    "join_column",
    "join_on_keys",
    "load_preparation",
    "may_broadcast",
    "merge_category_tables",
    "merge_preparations",
    "save_preparation",
    "sketch_keys",
    "split_target",
    "to_vectors",
    "transform",
]
