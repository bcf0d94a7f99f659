"""Components of the Jaccard join against all pairs."""

from __future__ import annotations

import random

import numpy as np

from helpers import documents, odd_rows, plain, prose
from plan import plan
from strataflow.llm import jaccard
from strataflow.llm.jaccard import common, components_of, fewest

LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))


def grams(text, k=5):
    words = (text or "").encode().translate(LOWER).split()
    return {tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))} if words else set()


def brute_force(rows, percent=80):
    sets = [grams(text) for _, text, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        least[find(i)] = min((x for x in (least.get(find(i)), doc_id) if x is not None), default=None)
    return sorted(((r[0], len(s), least[find(i)]) for i, (r, s) in enumerate(zip(rows, sets))), key=repr)


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        at = rng.randrange(len(words) or 1)
        words[at : at + rng.choice([0, 1, 1])] = [rng.choice(["new", "Other", "word"])] * rng.choice([0, 1])
    return " ".join(words)


def corpus(rng):
    passage = prose(rng, 60)
    rows = [(i, prose(rng, rng.choice([0, 1, 4, 5, 6, 8, 12, 60, 150])), "aa", "s") for i in range(120)]
    rows += [(200 + i, f"{passage} {prose(rng, rng.choice([0, 2, 6, 9, 14, 40]))}", "aa", "s") for i in range(60)]
    rows += [(300 + i, edited(rng, rows[rng.randrange(120)][1] + " end", rng.choice([1, 2, 4])), "aa", "s") for i in range(150)]
    base = prose(rng, 200)
    rows += [(500 + i, edited(rng, base, rng.choice([2, 3, 4, 5])), "aa", "s") for i in range(80)]  # near the limit to each other
    rows += [(600 + i, rows[i * 3][1].upper().replace(" ", " \n"), "aa", "s") for i in range(30)]
    rng.shuffle(rows)
    return rows


def test_against_all_pairs(spark):
    rng = random.Random(4)
    rows = corpus(rng) + odd_rows()
    found = plain(components_of(documents(spark, rows)))
    assert found == brute_force(rows)
    assert len({r[2] for r in found}) < len(rows) - 150
    assert plain(components_of(documents(spark, rows, extra=True), percent=60)) == brute_force(rows, 60)


def test_chains_link_what_is_not_alike(spark):
    rng = random.Random(5)
    words = prose(rng, 120).split()
    rows = [(i, " ".join(words[2 * i : 2 * i + 60]), "aa", "s") for i in range(30)]
    assert {r[2] for r in plain(components_of(documents(spark, rows)))} == {0}


def test_at_the_limit(spark):
    """Of ten shingles eight are shared: 8 / 10, 8 / 11 and, with nine, 9 / 11."""
    words = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join(words[:12]), "", ""), (2, " ".join(words[2:14]), "", ""), (3, " ".join(words[:14]), "", "")]
    assert plain(components_of(documents(spark, rows[:2]))) == [(1, 8, 1), (2, 8, 2)]
    assert plain(components_of(documents(spark, rows))) == [(1, 8, 1), (2, 8, 1), (3, 10, 1)]


def test_large_groups(spark):
    rng = random.Random(6)
    base = prose(rng, 100)
    rows = [(i, base, "aa", "s") for i in range(400)] + [(1000 + i, f"{base} tail{i}", "aa", "s") for i in range(400)]
    rows += [(3000 + i, f"{base} {prose(rng, 26)}", "aa", "s") for i in range(200)]
    found = dict((r[0], r[2]) for r in plain(components_of(documents(spark, rows))))
    assert {found[i] for i, *_ in rows[:800]} == {0}
    assert plain(components_of(documents(spark, rows[700:]))) == brute_force(rows[700:])


def test_suffix_filter_loses_nothing():
    rng = np.random.default_rng(7)
    for _ in range(500):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(1, 40))) for _ in range(2))
        for needed in (1, 5, 12):
            both = len(np.intersect1d(a, b))
            assert common(a, b, needed) == (both if both >= needed else 0)
    assert fewest(np.array([0, 1, 5, 10, 11]), 80).tolist() == [0, 1, 4, 8, 9]


def test_shingles_and_texts_are_shuffled_once(spark, monkeypatch):
    """Shingles go over the network once in each of the two steps that count them, texts once and only those that may have a partner."""
    plans = []

    def stored(df, path):
        plans.append(plan(df))
        return jaccard_stored(df, path)

    jaccard_stored = jaccard.stored
    monkeypatch.setattr(jaccard, "stored", stored)
    rng = random.Random(3)
    rows = [(i, prose(rng, 60)) for i in range(40)]
    rows += [(100 + i, rows[i][1] + " more") for i in range(6)] + [(200 + i, rows[i][1]) for i in range(4)]
    found = {r.doc_id: r.component_id for r in components_of(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(found[100 + i] == i for i in range(6)) and all(found[200 + i] == i for i in range(4))
    assert sum(p.count("hashpartitioning(gram") for p in plans) == 2
    assert sum(p.count("BroadcastHashJoin") for p in plans if "mapInArrow" in p or "MapInArrow" in p) >= 1


def test_few_but_the_wanted_rows_pass_the_map(spark):
    rows = spark.range(2000).selectExpr("unhex(md5(cast(id % 1000 AS string))) AS name", "IF(id % 3 = 0, NULL, id) AS doc_id", "'t' AS text")
    wanted = rows.limit(50)
    found = jaccard._maybe_wanted(rows, wanted)
    assert found.columns == rows.columns
    assert wanted.exceptAll(found).count() == 0 and found.count() <= 60
