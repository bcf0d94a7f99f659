"""Features and scores of random tables against a plain Python model of them."""

from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strataflow.operators import LinearClassifier, fit
from strataflow.plans import feature_rows, gold_by_join, gold_in_place, predictions
from strataflow.spec import FeatureSpec

SPEC = FeatureSpec(("id",), ("a", "b"), ("x", "y"))
TEXT = st.sampled_from([None, "1", "10", "2", "B5 C6", "é", "it's", "`q`", ""])
NUMBER = st.sampled_from([None, "0", "-1.5", "2e3", "NaN", "7.25", " 3 "])
ROWS = st.lists(st.tuples(TEXT, TEXT, NUMBER, NUMBER), min_size=1, max_size=12)


def plain_number(text):
    value = None if text is None else float(text)
    return None if value is None or math.isnan(value) else value


def model_of(rows):
    """Categories, ranges, and per row the two groups of features or None."""
    numbers = [(plain_number(r[2]), plain_number(r[3])) for r in rows]
    whole_texts = [r[:2] for r in rows if None not in r[:2]]
    whole_numbers = [n for n in numbers if None not in n]
    if not whole_texts or not whole_numbers:
        return None
    categories = [sorted({r[i] for r in whole_texts}) for i in range(2)]
    ranges = [(min(n[i] for n in whole_numbers), max(n[i] for n in whole_numbers)) for i in range(2)]
    features = []
    for row, pair in zip(rows, numbers):
        hot = [float(row[i] == c) for i in range(2) for c in categories[i]]
        scaled = [
            None if v is None else (v - low) / ((high - low) or 1.0) for v, (low, high) in zip(pair, ranges)
        ]
        features.append((hot, None not in row[:2], scaled, None not in pair))
    return categories, features


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)
@given(rows=ROWS)
def test_random_table(spark, rows):
    expected = model_of(rows)
    table = spark.createDataFrame(
        [(str(i), *r) for i, r in enumerate(rows)], "id string, a string, b string, x string, y string"
    )
    if expected is None:
        return
    categories, features = expected
    fitted = fit(table, SPEC)
    assert [list(c) for c in fitted.categories.values()] == categories

    silver = feature_rows(table, fitted, SPEC)
    found = {int(r[0]): list(r[1:]) for r in silver.collect()}
    for i, (hot, texts, scaled, numbers) in enumerate(features):
        assert found[i] == (hot if texts else [None] * len(hot)) + (scaled if numbers else [None, None])

    streamed = feature_rows(table, fitted, SPEC, on_unknown="ignore", incomplete="encode")
    found = {int(r[0]): list(r[1:]) for r in streamed.collect()}
    assert all(found[i] == hot + scaled for i, (hot, _, scaled, _) in enumerate(features))

    weights = tuple(0.5 - 0.3 * (i % 5) for i in range(len(fitted.feature_names)))
    model = LinearClassifier("label", tuple(fitted.feature_names), (0, 1), (weights,), (-0.15,))
    in_place = sorted(tuple(r) for r in gold_in_place(table, fitted, model, SPEC).select("id", "label").collect())
    joined = sorted(tuple(r) for r in gold_by_join(table, silver, model, SPEC).select("id", "label").collect())
    alone = sorted(tuple(r) for r in predictions(silver, model, SPEC).collect())
    assert in_place == joined == alone
    assert [int(r[0]) for r in sorted(in_place, key=lambda r: int(r[0]))] == [
        i for i, (_, texts, _, numbers) in enumerate(features) if texts and numbers
    ]
