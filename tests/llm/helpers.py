"""Documents with everything that may be odd about them."""

from __future__ import annotations

import random

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "pe", "ri", "so", "tu", "va", "ze") for b in ("", "b", "na", "rt", "sim", "tol")]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_rows() -> list[tuple]:
    """(doc_id, text, lang, source): nulls in each column, empty, blank and long texts, ties, repeated rows, odd characters."""
    rng = random.Random(11)
    shared = prose(rng, 120)
    rows = [(i, prose(rng, rng.choice([3, 20, 60, 150])), "aa", f"s{i % 3}") for i in range(12)]
    rows += [
        (20, None, "aa", "s0"), (21, "", "aa", "s0"), (22, " \t\n ", None, None), (23, "x", "aa", "s1"),
        (24, shared, "aa", "s1"), (25, shared, "aa", "s1"), (25, shared, "aa", "s1"), (25, "other " + shared, "aa", "s1"),
        (None, shared + " end", "aa", "s2"), (None, None, None, None), (-5, "ÄÖ 日本語 🙂    é \x00", "bb", "s2"),
        (26, prose(rng, 4000) + "\n" + "y" * 30_000, "aa", "s2"), (27, "one\n\none\ntwo\r\n", "bb", ""),
    ]
    return rows


def documents(spark, rows=None, extra: bool = False):
    rows = odd_rows() if rows is None else rows
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    if extra:  # names that operators use themselves
        for name in ("key", "kept", "name", "body", "row", "n_words", "score", "bucket", "slot", "c0", "number", "a.b"):
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def plain(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
