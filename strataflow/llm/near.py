"""Near duplicates by Order MinHash, verified by banded alignment.

Texts are sequences of five-word shingles. ``SKETCHES`` times the ``LENGTH`` least occurrence-numbered shingles of a text are taken in their
order and hashed: texts that share such a number are candidates. A text too short to have sketches without one of its shingles has
candidates of its own: all its shingles, and all but one of them. Two texts are near when an alignment of their
shingles matches at least ``SIMILARITY`` of all that either has, in order; classes are the connected components.

Candidates of a bucket are not compared all with all (see ``graph.linked``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.arrays import SMALL_SLICE, mix, occurrence_labels, order_minhash, shingles, slices, word_hashes
from strataflow.llm.graph import every_link, linked, stored
from strataflow.sources import scratch_path

WORDS = 5
LENGTH = 5
SKETCHES = 24
SIMILARITY = 0.8
PARITY_BITS = 1024


def aligned(a: np.ndarray, b: np.ndarray, similarity: float) -> float:
    """Matched shingles of the best alignment over all shingles of both, or 0 if that is less than ``similarity``.

    With m matches the share is m / (len(a) + len(b) - m), so only so many may be unmatched, and an
    alignment cannot leave the diagonal further than that. The band is a number of that many bits, one for each
    place, that moves along the diagonal; a cleared bit is a match (bit-parallel longest common subsequence).
    """
    total = len(a) + len(b)
    if not total:
        return 1.0
    needed = int(np.ceil(similarity * total / (1 + similarity) - 1e-9))
    limit = min(len(a), len(b))
    if needed > limit:
        return 0.0
    differ = np.flatnonzero(a[:limit] != b[:limit])
    head = int(differ[0]) if len(differ) else limit
    rest = limit - head
    differ = np.flatnonzero(a[len(a) - rest :][::-1] != b[len(b) - rest :][::-1])
    tail = int(differ[0]) if len(differ) else rest
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    matched = head + tail
    if len(a) and len(b) and matched + len(np.intersect1d(a, b)) < needed and matched + np.isin(b, a).sum() < needed:
        return 0.0
    if len(a) and len(b):
        reach = max(len(a) + len(b) - 2 * (needed - matched), abs(len(a) - len(b)))
        places: dict[int, list[int]] = {}
        for i, gram in enumerate(a.tolist()):
            places.setdefault(gram, []).append(i)
        width = 2 * reach + 1
        mask = (1 << width) - 1
        band = mask  # bit k is place row - reach + k of ``a``
        for row, gram in enumerate(b.tolist()):
            hits = 0
            for i in places.get(gram, ()):
                at = i - row + reach
                if 0 <= at < width:
                    hits |= 1 << at
            if hits:
                hits &= band
                band = ((band + hits) | (band - hits)) & mask
            matched += not band & 1  # this place leaves the band
            band = band >> 1 | 1 << (width - 1)
        matched += width - band.bit_count()
    share = matched / (total - matched)
    return share if share >= similarity else 0.0


def short_keys(grams: np.ndarray, bounds: np.ndarray, length: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that texts of at most ``length`` + 1 shingles share if one has all shingles of the other and at most one more, and their bounds.

    They are only there for sizes at which one shingle more leaves ``similarity``.
    """

    def hashed(rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), rows.shape[1] + 1, dtype=np.uint64)
        for j in range(rows.shape[1]):
            total = mix(total * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
        return total

    sizes = np.diff(bounds)
    owner, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for n in range(1, length + 2):
        chosen = np.flatnonzero(sizes == n)
        rows = grams[bounds[:-1][chosen][:, None] + np.arange(n)]
        found = [rows] if n <= length and n >= similarity * (n + 1) - 1e-9 else []
        found += [np.delete(rows, k, axis=1) for k in range(n)] if n > 1 and n - 1 >= similarity * n - 1e-9 else []
        owner += [chosen] * len(found)
        keys += [hashed(x) for x in found]
    owner, keys = np.concatenate(owner), np.concatenate(keys)
    order = np.argsort(owner, kind="stable")
    return keys[order], np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(sizes)))))


def _sketch(batches: Iterator[pa.RecordBatch], words: int, length: int, sketches: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """(text, key, doc_id, body) to (text, key, doc_id, n_grams, sketches, short)."""
    for batch in batches:
        for first, end, data, offsets in slices(batch.column(3), SMALL_SLICE):
            grams, bounds = shingles(*word_hashes(data, offsets), words)
            numbers = order_minhash(occurrence_labels(grams, bounds), bounds, sketches, length).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, numbers.size + 1, sketches, dtype=np.int32)), pa.array(numbers.ravel()))
            numbers, ends = short_keys(grams, bounds, length, similarity)
            short = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(numbers.view(np.int64)))
            columns = [batch.column(i).slice(first, end - first) for i in range(3)] + [pa.array(np.diff(bounds)), lists, short]
            yield pa.RecordBatch.from_arrays(columns, ["text", "key", "doc_id", "n_grams", "sketches", "short"])


def parities(labels: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """``PARITY_BITS`` bits per text as signed numbers: of each bit, whether an odd number of its shingles fell on it.

    Two texts differ in at least as many shingles as in bits.
    """
    out = np.zeros((len(bounds) - 1, PARITY_BITS // 64), dtype=np.int64)
    places = (labels >> np.uint64(20)).astype(np.int64) % PARITY_BITS
    for i, (start, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        odd = (np.bincount(places[start:end], minlength=PARITY_BITS) & 1).astype(np.uint8)
        out[i] = np.packbits(odd).view(np.int64)
    return out


def _sequences(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(text, body) to (text, grams, bits): the shingles as 32-bit numbers, and parities."""
    for batch in batches:
        for first, end, data, offsets in slices(batch.column(1), SMALL_SLICE):
            grams, bounds = shingles(*word_hashes(data, offsets), words)
            raw = pa.py_buffer(np.ascontiguousarray(grams.astype("<u4")))
            ends = pa.py_buffer((bounds * 4).astype(np.int32))
            column = pa.Array.from_buffers(pa.binary(), end - first, [None, ends, raw])
            bits = parities(occurrence_labels(grams, bounds), bounds)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, bits.size + 1, bits.shape[1], dtype=np.int32)), pa.array(bits.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), column, lists], ["text", "grams", "bits"])


def _verify(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """(a, b, grams of a, grams of b) to the pairs that are near."""
    for batch in batches:
        left, right = batch.column(2), batch.column(3)
        near = [
            aligned(np.frombuffer(left[i].as_buffer(), "<u4"), np.frombuffer(right[i].as_buffer(), "<u4"), similarity)
            for i in range(batch.num_rows)
        ]
        found = pa.array(np.flatnonzero(np.array(near) > 0))
        columns = [batch.column(i).take(found) for i in range(2)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(near, pa.float64()).take(found)], ["a", "b", "similarity"])


class NearDuplicates:
    """Classes of near-duplicate texts of a table; ``members`` and ``links`` are stored tables, ``links`` span each class."""

    def __init__(
        self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY,
        words: int = WORDS, length: int = LENGTH, sketches: int = SKETCHES,
    ):
        self.folder = scratch_path(docs.sparkSession, "near")
        self.similarity, self.words = similarity, words
        body = F.coalesce(F.col(text_column).cast("binary"), F.lit(b""))
        rows = docs.select(F.xxhash64(body).alias("text"), F.xxhash64(id_column, body).alias("key"), F.col(id_column).alias("doc_id"), body.alias("body"))
        kind = dict(rows.dtypes)["doc_id"]
        schema = f"text bigint, key bigint, doc_id {kind}, n_grams bigint, sketches array<bigint>, short array<bigint>"
        self.rows = rows
        self.members = self._stored(rows.mapInArrow(lambda b: _sketch(b, words, length, sketches, similarity), schema), "members")
        self._find()

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        return stored(df, f"{self.folder}/{name}")

    def _find(self) -> None:
        marks = self.members.where("n_grams > 0").select("text", "n_grams", F.explode(F.concat("sketches", "short")).alias("bucket")).distinct()
        shared = marks.groupBy("bucket").agg(F.count(F.lit(1)).alias("company")).where("company > 1").select("bucket")
        marks = self._stored(marks.join(shared, "bucket", "left_semi").withColumnRenamed("text", "member"), "marks")

        candidates = marks.select(F.col("member").alias("text")).distinct()
        one = self.members.groupBy("text").agg(F.min("key").alias("key")).join(candidates, "text", "left_semi")
        bodies = self.rows.join(one, ["text", "key"], "left_semi").select("text", "body")
        words, similarity = self.words, self.similarity
        grams = bodies.mapInArrow(lambda b: _sequences(b, words), "text bigint, grams binary, bits array<bigint>")
        grams = self._stored(grams.dropDuplicates(["text"]), "grams")
        parity = [f"bits_{i}" for i in range(PARITY_BITS // 64)]
        columns = [F.get("bits", F.lit(i)).alias(name) for i, name in enumerate(parity)]
        marks = marks.join(grams.select(F.col("text").alias("member"), *columns), "member")

        def like(a, b):
            """Whether the sizes, and the shingles that differ for certain, allow the similarity at all."""
            both = a("n_grams") + b("n_grams")
            fewest = F.ceil(both * (similarity / (1 + similarity)) - 1e-9)  # matches that are needed
            differ = sum((F.bit_count(a(c).bitwiseXOR(b(c))) for c in parity[1:]), F.bit_count(a(parity[0]).bitwiseXOR(b(parity[0]))))
            return (F.least(a("n_grams"), b("n_grams")) >= fewest) & (differ <= both - 2 * fewest)

        def verify(pairs: DataFrame) -> DataFrame:
            left = grams.select(F.col("text").alias("a"), F.col("grams").alias("grams_a"))
            right = grams.select(F.col("text").alias("b"), F.col("grams").alias("grams_b"))
            both = pairs.join(left, "a").join(right, "b").select("a", "b", "grams_a", "grams_b")
            return both.mapInArrow(lambda b: _verify(b, similarity), "a bigint, b bigint, similarity double")

        self.links, roots = linked(marks, ["n_grams", *parity], like, verify, f"{self.folder}/links")
        self.roots = roots.withColumnRenamed("node", "text")
        self._every_link = lambda: every_link(marks, ["n_grams", *parity], like, verify)

    def classes(self, count_links: bool = False) -> DataFrame:
        """One row per row of the table: doc_id, class_id (the least id in it), class_size, whether it is first; and n_links of its text if wanted.

        Rows with equal texts are in one class, also texts without words. Null ids are in classes like others, but name a
        class only if it has no other id. ``n_links`` counts the different texts near to this one that share a sketch with it, whether or not the
        class needs the link. For that all pairs of a bucket are compared, which grows with the square of a group, so it is left out unless
        ``count_links`` asks for it; classes need no more than links that span them.
        """
        rows = self.members.select("text", "key", "doc_id").join(self.roots, "text", "left").withColumn("root", F.coalesce("root", "text"))
        classes = self._stored(rows.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")), "classes")
        first = F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)).alias("names_class")
        rows = rows.join(classes, "root")
        if not count_links:
            return rows.select("doc_id", "class_id", "class_size", first)
        pairs = self._stored(self._every_link().select("a", "b"), "every_link")
        degree = pairs.select(F.explode(F.array("a", "b")).alias("text")).groupBy("text").agg(F.count(F.lit(1)).alias("n_links"))
        n_links = F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")
        return rows.join(degree, "text", "left").select("doc_id", "class_id", "class_size", n_links, first)

    def first_of_each(self) -> DataFrame:
        """(text, key) of one row per class: that with the least id, nulls last; rows that repeat share both."""
        rows = self.members.join(self.roots, "text", "left").withColumn("root", F.coalesce("root", "text"))
        first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text", "key"))
        return rows.groupBy("root").agg(first.alias("first")).select("first.text", "first.key")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", count_links: bool = False, **options
) -> DataFrame:
    """One row per document with the class of its near duplicates (see ``NearDuplicates.classes``).

    A null text is empty. Texts of fewer than five words have one shingle of all their words; texts without words are
    near to equal ones only. Other columns of ``docs`` are not read.
    """
    return NearDuplicates(docs, id_column, text_column, **options).classes(count_links)


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, with one row for each class: that with the least id; nulls count as largest."""
    found = NearDuplicates(docs, id_column, text_column, **options)
    body = F.coalesce(F.col(text_column).cast("binary"), F.lit(b""))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(body).alias("text"), F.xxhash64(id_column, body).alias("key"))
    kept = rows.join(found._stored(found.first_of_each(), "first"), ["text", "key"], "left_semi")
    # rows that repeat in all that decides are alike: one of them stays
    number = F.row_number().over(Window.partitionBy("text", "key").orderBy(F.lit(1)))
    return kept.withColumn("number", number).where("number = 1").select("row.*")
