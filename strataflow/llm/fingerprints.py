"""Document fingerprints by Order MinHash, and how like neighbours and edited texts are by them.

A fingerprint has ``COUNT`` numbers. For each of as many random orders the ``LENGTH`` least occurrence-numbered shingles
of five words are taken, kept in the order of the text, and hashed as a tuple. The share of equal numbers is
near the share of tuples that an edit leaves alone, and falls when parts of the text change places.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.arrays import SLICE_BYTES, occurrence_labels, order_minhash, shingles, word_hashes

WORDS = 5
LENGTH = 2
COUNT = 32

OUT = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def fingerprints(texts: list[bytes], words: int = WORDS, count: int = COUNT, length: int = LENGTH) -> np.ndarray:
    """One row of ``count`` 32-bit numbers per text; zeros for a text without words."""
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    grams, bounds = shingles(*word_hashes(data, offsets), words)
    return order_minhash(occurrence_labels(grams, bounds), bounds, count, length).astype("<u4")


def _in_order(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows (bucket, is_copy, doc_id, text) such that the next row of the same bucket is the next document.

    Documents are dealt out by ranges of ids. The first document of each range is copied to the end of the range
    before it, and the first of all to the end of the last. Null ids come last, dealt out over 64 ranges of the hashes of their texts.
    """
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("binary"), F.lit(b"")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.approxQuantile("doc_id", [i / (4 * parts) for i in range(1, 4 * parts)], 0.1 / parts)
    splits = [float("-inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    number = F.col("doc_id").cast("double")
    dealt = Bucketizer(splits=splits, inputCol="number", outputCol="range").transform(rows.withColumn("number", F.coalesce(number, F.lit(0.0))))
    of_nulls = F.lit(len(splits)) + (F.shiftright("tie", 58) + 32).cast("int")  # come last, in the order of their texts' hashes
    bucket = F.when(F.col("doc_id").isNull(), of_nulls).otherwise(len(splits) - 1 - F.col("range").cast("int"))
    dealt = dealt.select("doc_id", "text", "tie", bucket.alias("bucket"))
    # the complement turns the order round and has a value for each id; null ids stand alone in their buckets
    first = F.min(F.struct(F.bitwise_not("doc_id").alias("least"), "tie")).alias("first")
    heads = sorted((r.bucket, r.first.least, r.first.tie) for r in dealt.groupBy("bucket").agg(first).collect())
    before = [heads[i - 1][0] for i in range(len(heads))]  # of the first one: the last
    table = [(b, None if least is None else ~least, tie, to) for (b, least, tie), to in zip(heads, before)]
    copies = spark.createDataFrame(table, "bucket int, head_id bigint, head_tie bigint, copy_to int")
    is_head = (F.col("tie") == F.col("head_tie")) & F.col("doc_id").eqNullSafe(F.col("head_id"))
    places = F.array(
        F.struct("bucket", F.lit(False).alias("is_copy")), F.when(is_head, F.struct(F.col("copy_to").alias("bucket"), F.lit(True).alias("is_copy")))
    )
    # one row per range, and there are four ranges per shuffle partition and 64 for null ids
    placed = dealt.join(F.broadcast(copies), "bucket").withColumn("place", F.explode(F.array_compact(places)))
    return (
        placed.select("place.bucket", "place.is_copy", "doc_id", "text", "tie")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "is_copy", F.col("doc_id").desc_nulls_last(), "tie")
        .select("bucket", "is_copy", "doc_id", "text")
    )


def _edit(text: str, following: str) -> str:
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _compare(rows: list[tuple[int, bool, int | None, bytes]]) -> pa.RecordBatch | None:
    """Results for all rows but the last, each with the row after it."""
    at = [i for i in range(len(rows) - 1) if not rows[i][1]]
    if not at:
        return None
    if any(rows[i][0] != rows[i + 1][0] for i in at):
        raise ValueError("a range of documents does not end with the first of the next")
    texts = [r[3].decode("utf-8", "replace") for r in rows]
    edited = [_edit(texts[i], texts[i + 1]).encode() for i in at]
    prints = fingerprints([r[3] for r in rows])
    edited_prints = fingerprints(edited)
    own, following = prints[at], prints[np.array(at) + 1]
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([rows[i][2] for i in at], pa.int64()),
            "n_chars": pa.array([len(texts[i]) for i in at], pa.int64()),
            "edited_sha256": [hashlib.sha256(e).hexdigest() for e in edited],
            "fingerprint": [p.tobytes().hex() for p in own],
            "edited_fingerprint": [p.tobytes().hex() for p in edited_prints],
            "near_edited": (own == edited_prints).mean(axis=1),
            "near_next": (own == following).mean(axis=1),
        }
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for batch in batches:
        buckets, copies, ids = (batch.column(i).to_pylist() for i in range(3))
        texts = pc.cast(batch.column(3), pa.binary())
        for i, row in enumerate(zip(buckets, copies, ids)):
            text = texts[i].as_py()
            rows.append((*row, text))
            size += len(text)
            if size >= SLICE_BYTES:
                if (out := _compare(rows)) is not None:
                    yield out
                rows = rows[-1:]
                size = len(rows[0][3])
    if rows and (out := _compare(rows)) is not None:
        yield out


def document_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: fingerprints of its text and its edited text, and their likeness.

    The edited text has its last third (rounded down, in code points) replaced by the start of the next document,
    in descending order of the id; after the last comes the first. Null ids come last, and documents with one id go by
    a hash of the text. ``near_edited`` and ``near_next`` are shares of equal numbers. A null text is empty; texts
    without words have the fingerprint zero, and are like each other only. A single document is its own next.
    Other columns of ``docs`` are not read.
    """
    return _in_order(docs, id_column, text_column).mapInArrow(_walk, f"doc_id bigint, {OUT}")
