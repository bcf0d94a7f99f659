from __future__ import annotations

import random
from collections import Counter

from helpers import documents, odd_rows, prose
from strataflow.llm.compression import compression_bands


def counted(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i, window in enumerate(zip(words, words[1:], words[2:])):
        if windows[window] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_base_counts(spark):
    rng = random.Random(4)
    rows = odd_rows() + [(100 + i, prose(rng, 30).replace(" ", rng.choice([" ", "\n", " # "]), 9) * 3, None, None) for i in range(20)]
    found = compression_bands(documents(spark, rows)).collect()
    got = [tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in found]
    assert Counter(got) == Counter(counted(r[1]) for r in rows)


def test_bands_reject_what_repeats_and_what_is_noise(spark):
    rng = random.Random(5)
    clean = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(900))
    numbers = " ".join(f"the-same-long-item-again-and-again-{i}" for i in range(3000))
    noise = " ".join("".join(chr(rng.randint(33, 126)) for _ in range(40)) for _ in range(400))
    rows = [(1, clean, None, None), (2, numbers, None, None), (3, noise, None, None), (4, clean[:600], None, None)]
    found = {r["doc_id"]: r for r in compression_bands(documents(spark, rows)).collect()}
    assert found[1]["kept"] and found[4]["kept"]
    assert not found[2]["base_failed"] and not found[2]["kept"] and found[2]["n_chunks_low"] == found[2]["n_chunks"] > 5
    assert not found[3]["base_failed"] and not found[3]["kept"] and found[3]["n_chunks_high"] > 1
