from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from helpers import documents, odd_rows, plain
from strataflow.llm import language

SYLLABLES = {"aa": ["ka", "lo", "mi", "ra", "tu"], "bb": ["sch", "ung", "ein", "heit", "ver"], "cc": ["ção", "que", "lho", "nha", "ka"]}


def text(rng, name, n):
    return " ".join("".join(rng.choice(SYLLABLES[name]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows(n=150):
    rng = random.Random(5)
    names = [rng.choice(list(SYLLABLES)) for _ in range(n)]
    return [(i, text(rng, name, 60).title(), name, "s") for i, name in enumerate(names)]


def by_hand(words, order):
    """Interpolated Kneser-Ney with dictionaries: a function from context and character to the probability."""
    counts = [Counter() for _ in range(order + 1)]
    for word, often in words.items():
        marked = "\x01" + word + "\x02"
        for end in range(1, len(marked)):
            for n in range(1, min(order, end + 1) + 1):
                counts[n][marked[end - n + 1 : end + 1]] += often
    adjusted = [Counter(c) for c in counts]
    for n in range(1, order):
        left = Counter(g[1:] for g in counts[n + 1])
        for gram in adjusted[n]:
            if not gram.startswith("\x01"):
                adjusted[n][gram] = max(left[gram], 1)
    alphabet = len(counts[1])
    totals, kinds, discounts = [defaultdict(float) for _ in range(order + 1)], [Counter() for _ in range(order + 1)], [0.0] * (order + 1)
    for n in range(1, order + 1):
        once, twice = (sum(v == k for v in adjusted[n].values()) for k in (1, 2))
        discounts[n] = once / (once + 2 * twice) if once and twice else 0.5
        for gram, count in adjusted[n].items():
            totals[n][gram[:-1]] += count
            kinds[n][gram[:-1]] += 1

    def probability(gram):
        n = len(gram)
        if n == 0:
            return 1 / (alphabet + 1)
        lower = probability(gram[1:])
        total = totals[n].get(gram[:-1])
        if not total:
            return lower
        share = max(adjusted[n].get(gram, 0) - discounts[n], 0) / total
        return share + discounts[n] * kinds[n][gram[:-1]] / total * lower

    return lambda word: -sum(
        math.log(probability(("\x01" + word + "\x02")[max(0, end - order + 1) : end + 1])) for end in range(1, len(word) + 2)
    )


def test_model_against_dictionaries():
    rng = random.Random(1)
    words = Counter(text(rng, "aa", 300).split())
    model = language.fit_model({"aa": dict(words)}, 4)
    tried = [*list(words)[:40], "zzz", "kax", "k", "lomilomilo", "ß"]
    sums, sizes = model.score_words(tried)
    score = by_hand(words, 4)
    assert sizes.tolist() == [len(w) + 1 for w in tried]
    assert np.allclose(sums[:, 0], [score(w) for w in tried])


def test_probabilities_sum_to_one():
    words = Counter(text(random.Random(1), "bb", 300).split())
    model = language.fit_model({"bb": dict(words), "aa": {"ka": 3}}, 3)
    letters = sorted(set("".join(words)) | set("ka"))
    for start in ("", "s", "sch", "ein"):
        sums, _ = model.score_words([start + c for c in letters] + [start])
        end, _ = model.score_words([start])
        grams, contexts, owner = language.gram_hashes([start + c for c in letters], 3)
        rows = np.array([np.flatnonzero(owner == i)[len(start)] for i in range(len(letters))])
        depth = min(3, len(start) + 2)
        inner = model._probability(depth, grams, contexts, rows)
        grams, contexts, owner = language.gram_hashes([start], 3)
        last = model._probability(min(3, len(start) + 2), grams, contexts, np.array([len(start)]))
        total = (inner.sum(axis=0) + last[0])
        assert ((total > 0.9) & (total < 1 + 1e-9)).all()  # the rest is for letters never met


def test_held_out_accuracy(spark):
    found = {r["doc_id"]: r for r in language.identify(documents(spark, rows())).collect()}
    for doc_id, _, name, _ in rows():
        assert found[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert found[doc_id]["lang_pred"] == name and 0.9 < found[doc_id]["score"] <= 1 and not found[doc_id]["rejected"]
    assert sum(r["held_out"] for r in found.values()) > 20


def test_only_learns_from_what_it_may(spark):
    """Labels of held-out documents, and of those without one, change nothing."""
    changed = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else n, "other") for i, t, n, _ in rows()]
    assert plain(language.identify(documents(spark, changed))) == plain(language.identify(documents(spark, rows())))


def test_odd_texts_and_rejection(spark):
    docs = rows() + [(5000, "123 ... !!", "aa", "s"), (5001, None, "aa", "s"), (5002, "", None, None), (5003, "漢字" * 200, None, None), (5004, "ka", None, None)]
    found = {r["doc_id"]: r for r in language.identify(documents(spark, docs)).collect()}
    for i in (5000, 5001, 5002):
        assert found[i]["lang_pred"] == "und" and found[i]["score"] == 0 and found[i]["rejected"]
    assert found[5003]["rejected"] and found[5003]["lang_pred"] in SYLLABLES
    assert not found[5004]["rejected"]
    kept = language.accepted(documents(spark, docs, extra=True))
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in docs} - {5000, 5001, 5002, 5003}


def test_without_labels(spark):
    bare = [(r[0], r[1], None, r[3]) for r in odd_rows()]
    found = language.identify(documents(spark, bare)).collect()
    assert {r["lang_pred"] for r in found} == {"und"} and any(not r["rejected"] for r in found)


def test_a_language_with_long_texts_only_is_learned(spark):
    rows = [(i, "ka lo mi nu pe " * 20, "aa", "s") for i in range(40)] + [(100 + i, "zeb zort zasim zetol " * 2000, "bb", "s") for i in range(40)]
    found = language.identify(documents(spark, rows)).collect()
    assert all(r["lang_pred"] == ("aa" if r["doc_id"] < 100 else "bb") for r in found)


def test_the_sample_of_rows_without_ids_is_bounded(spark):
    rows = documents(spark, [(None, f"ka lo mi nu {i}", "aa", "s") for i in range(3000)] + [(None, "so tu", "aa", "s")] * 3000)
    seen = []
    original = language.fit_model
    try:
        language.fit_model = lambda counts: seen.append(counts) or original(counts)
        language.train(rows, sample_documents=300)
    finally:
        language.fit_model = original
    assert 0 < max(seen[0]["aa"].values()) < 450
