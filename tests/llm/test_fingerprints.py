from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from helpers import documents, odd_rows, prose
from strataflow.llm import fingerprints
from strataflow.llm.arrays import occurrence_labels, order_minhash, shingles, word_hashes


def test_edits_and_neighbours(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.choice([1, 10, 200])), None, None) for i in rng.sample(range(-500, 500), 90)]
    rows += [r for r in odd_rows() if r[0] not in (None, 25) and r[0] not in {x[0] for x in rows}]
    ordered = sorted(rows, key=lambda r: -r[0])
    found = {r["doc_id"]: r for r in fingerprints.document_fingerprints(documents(spark, rows)).collect()}
    assert len(found) == len(rows)
    for i, (doc_id, text, *_) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        row = found[doc_id]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        prints = fingerprints.fingerprints([text.encode(), edited.encode(), following.encode()])
        assert row["fingerprint"] == prints[0].tobytes().hex() and row["edited_fingerprint"] == prints[1].tobytes().hex()
        assert row["near_edited"] == (prints[0] == prints[1]).mean() and row["near_next"] == (prints[0] == prints[2]).mean()


def test_single_document_and_ties(spark):
    (row,) = fingerprints.document_fingerprints(documents(spark, [(7, "a b c d e f", None, None)])).collect()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(b"a b c d a b").hexdigest() or row["near_next"] == 1.0
    rows = [(7, "a b c", None, None)] * 3 + [(None, "x", None, None)] * 2
    assert fingerprints.document_fingerprints(documents(spark, rows)).count() == 5


def test_against_a_plain_sketch():
    """The least grams by the same random orders, text by text and gram by gram."""
    rng = random.Random(1)
    texts = [prose(rng, n) for n in (0, 1, 4, 5, 30, 200)] + ["ka ka ka ka ka ka ka ka"]
    data = "".join(texts).encode()
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    grams, bounds = shingles(*word_hashes(np.frombuffer(data, np.uint8), offsets), 5)
    labels = occurrence_labels(grams, bounds)
    assert len(set(labels[bounds[-2] : bounds[-1]].tolist())) == bounds[-1] - bounds[-2] == 4
    together = order_minhash(labels, bounds, 8, 2)
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        alone = order_minhash(labels[a:b], np.array([0, b - a]), 8, 2)
        assert (alone[0] == together[i]).all()
    assert not together[0].any() and together[1:].all()


def test_order_and_edits_show():
    rng = random.Random(2)
    words = prose(rng, 400).split()
    moved = words[200:] + words[:200]
    small = words[:100] + ["other"] + words[101:]
    a, b, c, d = fingerprints.fingerprints([" ".join(w).encode() for w in (words, small, moved, prose(rng, 400).split())], count=256)
    assert (a == b).mean() > 0.9 > 0.8 > (a == c).mean() > (a == d).mean() == 0


def test_least_and_null_ids(spark):
    least = -(1 << 63)
    rows = [(least, "the first text of all", None, None), (least + 1, "another text", None, None), (1 << 62, "a third one", None, None)]
    rows += [(None, f"text {i} without an id", None, None) for i in range(400)]
    docs = documents(spark, rows)
    found = fingerprints.document_fingerprints(docs).collect()
    assert len(found) == len(rows)
    texts = {hashlib.sha256(edit.encode()).hexdigest(): a for a, edit in _edits(spark, docs)}
    assert {r["edited_sha256"] for r in found} == set(texts)
    placed = fingerprints._in_order(docs, "doc_id", "text").where("doc_id is null and not is_copy")
    assert placed.select("bucket").distinct().count() > 40


def _edits(spark, docs):
    """Texts and edited texts by the order of the contract: ids descending, then null ids by the hash of the text."""
    order = [r["text"] for r in docs.selectExpr("doc_id", "text", "xxhash64(cast(text as binary)) as tie").orderBy(F.col("doc_id").desc_nulls_last(), "tie").collect()]
    for a, b in zip(order, order[1:] + order[:1]):
        cut = len(a) // 3
        yield a, a[: len(a) - cut] + b[:cut]
