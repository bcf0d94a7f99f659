"""Bit planes against plain arithmetic, and clusters against the rounds by hand."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from helpers import plain
from strataflow.llm.bitplanes import cluster, cluster_report, dots, from_planes, nearest, to_planes


@pytest.mark.parametrize("largest", [1, 2, 200, 1 << 27])
def test_planes_give_exact_dot_products(largest):
    rng = np.random.default_rng(1)
    a, b = rng.integers(-largest, largest, (40, 64)), rng.integers(-largest, largest, (7, 64))
    b[0], b[1] = 0, -1
    assert (from_planes(to_planes(a)) == a).all()
    assert (dots(to_planes(a), to_planes(b)) == a @ b.T).all()
    away = ((a[:, None] - b[None]) ** 2).sum(axis=2)
    number, distance = nearest(to_planes(a), b)
    assert (number == away.argmin(axis=1)).all() and (distance == away.min(axis=1)).all()


def by_hand(rows, clusters, rounds):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(256 * x) for x in v]))
    luck = lambda r: hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    centroids = [list(v) for _, v in sorted(kept, key=luck)[:clusters]]

    def assign():
        away = [[sum((x - y) ** 2 for x, y in zip(v, c)) for c in centroids] for _, v in kept]
        return [(a.index(min(a)), min(a)) for a in away]

    for _ in range(rounds):
        where = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (k, _) in zip(kept, where) if k == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine)]
    where = assign()
    total = {c: sum(d for k, d in where if k == c) for c in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i, c, d, total[c], sum(total.values()), digest[c]) for (i, _), (c, d) in zip(kept, where)), key=repr
    )


def table(spark, rows, kind="float", extra=""):
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")
    return df.selectExpr("*", *(f"'x' AS `{c}`" for c in extra.split()))


def vectors(rng, n):
    middle = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(6)]
    return [(i, [float(np.float32(x + rng.gauss(0, 0.2))) for x in rng.choice(middle)]) for i in range(n)]


def odd(rng):
    rows = vectors(rng, 4)
    same = vectors(rng, 1)[0][1]
    rows += [(10, None), (11, []), (12, [0.5] * 63), (13, [0.5] * 65), (14, [0.5] * 63 + [None]), (15, [0.5] * 63 + [float("nan")])]
    rows += [(16, [float("inf")] + [0.0] * 63), (17, [-float("inf")] + [0.0] * 63), (20, same), (21, same), (22, [0.0] * 64), (22, [0.0] * 64)]
    return rows + [(None, [1.0] * 64), (23, [900.25, -1e-9] * 32), (24, [-0.0] * 64)]


@pytest.mark.parametrize("n, clusters, rounds", [(200, 6, 5), (90, 40, 5), (10, 40, 2), (60, 1, 1), (30, 5, 0)])
def test_against_the_rounds_by_hand(spark, n, clusters, rounds):
    rng = random.Random(n)
    rows = vectors(rng, n) + [(1000 + i if i is not None else None, v) for i, v in odd(rng)]
    found = plain(cluster_report(table(spark, rows, extra="planes cluster n label value"), clusters=clusters, rounds=rounds))
    assert found == by_hand(rows, clusters, rounds)


def test_doubles_and_another_number_of_planes(spark):
    rng = random.Random(9)
    rows = [(i, [x * 10 ** (i % 6) for x in v]) for i, v in vectors(rng, 80)]
    df = table(spark, rows, "double").repartition(7)
    assert plain(cluster_report(df, clusters=5)) == by_hand(rows, 5, 5)


def test_no_vectors(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        found = cluster_report(table(spark, rows))
        assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert found.collect() == []


def test_vectors_whose_distance_does_not_fit(spark):
    with pytest.raises(Exception, match="beyond 2"):
        cluster(table(spark, [(1, [1e6] * 64)]))
