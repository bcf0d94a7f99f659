from __future__ import annotations

import hashlib
import random

import pytest

from helpers import documents, odd_rows, plain, prose
from strataflow.llm import repeats


def brute_force(rows, length):
    starts = {}
    for _, text, *_ in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            starts[data[i : i + length]] = starts.get(data[i : i + length], 0) + 1
    out = []
    for key, text, *_ in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if starts[data[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out.append((key, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def mosaics(n):
    rng = random.Random(7)
    parts = [prose(rng, 60) for _ in range(6)] + ["ab" * 60, "é日 " * 40]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rng.randint(0, 4)):
            part = rng.choice(parts)
            at = rng.randint(0, len(part))
            text += part[at : at + rng.randint(0, 200)] + (prose(rng, 5) if rng.random() < 0.3 else "")
        rows.append((i, text, None, None))
    return rows


@pytest.mark.parametrize("small", [20_000, 2])
def test_against_every_substring(spark, monkeypatch, small):
    monkeypatch.setattr(repeats, "SMALL_GROUP", small)
    rows = mosaics(90) + [r for r in odd_rows() if r[0] != 26]
    found = repeats.remove_repeats(documents(spark, rows), length=40, window=20, gram=8).drop("spans")
    expected = brute_force(rows, 40)
    assert sum(r[2] for r in expected) > 1000
    assert plain(found) == expected


def test_spans(spark):
    text = "x" + "abcdefghij" * 5 + "y"
    found = repeats.remove_repeats(documents(spark, [(1, text, None, None)]), length=40, window=20, gram=8).collect()[0]
    assert [(s["start"], s["end"]) for s in found["spans"]] == [(1, 51)]


def test_the_anchor_must_lie_in_the_string(spark):
    with pytest.raises(ValueError, match="within the string"):
        repeats.remove_repeats(documents(spark), length=40, window=40, gram=8)
