"""Every operator on nulls, empty and long texts, ties, repeated rows, no rows, and columns named like its own."""

from __future__ import annotations

import pytest

import corpus_pipeline
from helpers import documents, odd_rows, plain
from strataflow.llm import bpe, compression, fingerprints, jaccard, language, licenses, lines, mixing, near, repeats, runs

OPERATORS = {
    "compression": compression.compression_bands,
    "repeats": lambda df: repeats.remove_repeats(df, length=40, window=20, gram=8).drop("spans"),
    "mixing": lambda df: mixing.plan(df.select("doc_id", "source", *[c for c in df.columns if c not in ("doc_id", "source", "text", "lang")]), cycle=10),
    "bpe": bpe.encode_documents,
    "licenses": licenses.license_scan,
    "lines": lines.line_counts,
    "near": near.near_duplicates,
    "fingerprints": fingerprints.document_fingerprints,
    "language": language.identify,
    "jaccard": jaccard.components_of,
    "runs": runs.periodic_runs,
    "planted runs": lambda df: runs.run_counts(runs.planted(df)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document_whatever_it_is(spark, name):
    found = OPERATORS[name](documents(spark))
    assert sorted((r["doc_id"] for r in found.collect()), key=repr) == sorted((r[0] for r in odd_rows()), key=repr)


@pytest.mark.parametrize("name", [n for n in OPERATORS if n != "mixing"])
def test_other_columns_change_nothing(spark, name):
    assert plain(OPERATORS[name](documents(spark, extra=True))) == plain(OPERATORS[name](documents(spark)))


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(spark, name):
    assert OPERATORS[name](documents(spark, [])).collect() == []


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, name, stage):
    for rows in (None, []):
        docs = documents(spark, rows, extra=True)
        out = stage(spark, docs, "")
        if name == "tokens":
            assert out.count() == docs.count()
            continue
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert {r["doc_id"] for r in out.collect()} <= {r["doc_id"] for r in docs.collect()}
