"""Runs of words against all stretches of all periods, and what is left of the text."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from helpers import documents, odd_rows, plain, prose
from strataflow.llm.arrays import word_hashes
from strataflow.llm.runs import automaton, periodic_runs, planted, run_counts, runs, stretches


def brute_force(words, least=6, exponent=4):
    found = {}
    for q in range(1, len(words)):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i - q, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def repetitive(rng, size):
    letters = "abcdefgh"[: rng.choice([1, 2, 3, 5])]
    words = []
    while len(words) < size:
        words += [rng.choice(letters) for _ in range(rng.randint(1, 9))] * rng.choice([1, 1, 2, 4, 5, 6])
    return words


def test_runs_against_all_stretches():
    rng = random.Random(1)
    for _ in range(600):
        words = repetitive(rng, rng.choice([0, 4, 12, 40, 90]))
        assert runs(words) == brute_force(words)
        assert runs(words, 2, 5) == brute_force(words, 2, 5)


def test_the_automaton_knows_all_strings_and_no_other():
    words = list("abcbcabab")
    length, link, prefix = automaton(words)
    strings = {tuple(words[i:j]) for i in range(len(words)) for j in range(i + 1, len(words) + 1)}
    assert sum(length[v] - length[link[v]] for v in range(1, len(length))) == len(strings)
    assert [length[v] for v in prefix] == list(range(1, len(words) + 1))


def test_stretches_hold_all_runs_and_their_neighbours():
    rng = random.Random(2)
    for _ in range(200):
        texts = [repetitive(rng, rng.choice([0, 3, 30, 80])) for _ in range(4)]
        bodies = [" ".join(t).encode() for t in texts]
        offsets = np.cumsum([0, *map(len, bodies)])
        hashes, bounds = word_hashes(np.frombuffer(b"".join(bodies), np.uint8), offsets)
        places = stretches(hashes, bounds)
        for i, words in enumerate(texts):
            base, end = int(bounds[i]), int(bounds[i + 1])
            for s, n, _ in brute_force(words):
                first, last = max(base + s - 1, base), min(base + s + n + 1, end)
                assert any(b <= first and last <= e for b, e in places)
        assert all(any(bounds[i] <= b and e <= bounds[i + 1] for i in range(4)) for b, e in places)


@pytest.mark.parametrize("size", [1, 2, 3, 5000])
def test_long_periodic_texts(size):
    words = [str(i % size) for i in range(20_000)]
    assert runs(words) == [(0, 20_000, size)]


def test_overlapping_runs_and_ties(spark):
    text = "a b a b a b a b b b b b b b c c c c c c"
    rows = [(1, text, "aa", "s"), (2, text, "aa", "s"), (2, text, "aa", "s")]
    found = run_counts(documents(spark, rows)).collect()
    assert [r["n_runs"] for r in found] == [3, 3, 3]
    assert {(r["start"], r["length"], r["period"], r["exponent_milli"]) for r in found} == {(0, 8, 2, 4000)}
    left = periodic_runs(documents(spark, rows)).collect()[0]
    assert left["collapsed"] == "a b c" and [tuple(r) for r in left["runs"]] == [(0, 8, 2), (7, 7, 1), (14, 6, 1)]


def by_hand(doc_id, text, changed=True):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if changed and h % 10 == 0 and words:
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_force(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(((-n, s, q) for s, n, q in found), default=None)
    longest = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    digests = ("".join(f"{s},{n},{q}\n" for s, n, q in found).encode(), b" ".join(w for i, w in enumerate(words) if i not in gone))
    return (doc_id, len(found), *longest, *(hashlib.sha256(d).hexdigest() for d in digests))


def test_query_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.choice([1, 9, 40, 200])), "aa", "s") for i in range(150)]
    rows += [(1000 + i, " \n".join(repetitive(rng, 60)), "aa", "s") for i in range(60)]
    rows += [r for r in odd_rows() if r[1] is None or len(r[1]) < 3000]
    found = plain(run_counts(planted(documents(spark, rows, extra=True))))
    assert found == sorted((by_hand(doc_id, text) for doc_id, text, *_ in rows), key=repr)
    assert sum(r[1] > 0 for r in found) > 40
    left = plain(run_counts(documents(spark, rows)))
    assert left == sorted((by_hand(doc_id, text, False) for doc_id, text, *_ in rows), key=repr)


def test_periods_must_be_met_at_each_end(spark):
    with pytest.raises(ValueError):
        periodic_runs(documents(spark), exponent=3)
