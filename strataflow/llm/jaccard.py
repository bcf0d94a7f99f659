"""Jaccard join of documents by their word shingles, with rare-first prefix, length, positional and suffix filters.

A document is the set of its distinct shingles. Two link if their sets have at least ``PERCENT`` percent of their union in
common. All shingles have one order; a set of n shingles whose partners share at least m of them must share one of its first
n - m + 1 with each, its prefix. In rare-first order few sets meet there.

1. *Sets that may have a partner at all.* Taken in the order of their hashes, a prefix longer by l shares l shingles
   with each partner's. Only these are shuffled, and counted; sets with fewer that also stand elsewhere are done.
2. *Order.* For the sets that are left, all shingles are counted. What stands in one set only is the rarest and can be
   in no other, so it is just a number; the others are ordered by the power of two of their count, then by hash.
3. *Candidates* share a shingle of their prefixes, have like sizes, and enough behind the places of that shingle.
4. *Verification*, once for each pair: the suffix filter cuts both sets at the same shingles and compares the
   sizes of the parts, then what is left is intersected.

Copies of a text are one set with the first of them. Pairs within a component that is already known are not compared (see ``graph.linked``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.arrays import owners, shingles, slices, word_hashes
from strataflow.llm.graph import linked, stored
from strataflow.sources import scratch_path

WORDS = 5
PERCENT = 80
#: One in so many shingles makes the prefixes of the first step longer.
RESERVE = 16
#: Bits of a shingle's hash in the first step: equal ones by chance only leave sets in that have no partner.
SHORT = 40
#: Bits of the map of wanted texts that is broadcast, at most 262,144 rows whatever their number.
MAP_BITS = 1 << 24
#: Parts into which the suffix filter cuts two sets.
PARTS = 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text as ordered hashes, and bounds of texts in them."""
    grams, bounds = shingles(*word_hashes(_LOWER[data], offsets), words)
    own = owners(bounds)
    order = np.lexsort((grams, own))
    grams, own = grams[order], own[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (own[1:] != own[:-1])
    return grams[new], np.concatenate(([0], np.cumsum(np.bincount(own[new], minlength=len(bounds) - 1))))


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))


def fewest(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set of n shares with any partner at least."""
    return -(-n * percent // 100)


def _prefixes(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """(name, doc_id, text) to (number, name, doc_id, n_shingles, least, prefix), shingles by the upper ``SHORT`` bits.

    ``least`` is how many shingles of the prefix each partner's has. Numbers are given by partition and row.
    """
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << 36
    for batch in batches:
        for first, end, data, offsets in slices(batch.column(2)):
            grams, bounds = _sets(data, offsets, words)
            n = np.diff(bounds)
            smallest = fewest(n, percent)  # of a partner
            reserve, least = -(-n // RESERVE), -(-smallest // RESERVE)
            size = np.minimum(n - smallest + reserve, n)
            at = np.arange(len(grams)) - np.repeat(bounds[:-1], n)
            prefix = _lists(grams[at < np.repeat(size, n)] >> np.uint64(64 - SHORT), np.concatenate(([0], np.cumsum(size))))
            columns = [pa.array(np.arange(number, number + end - first)), *(batch.column(i).slice(first, end - first) for i in range(2))]
            columns += [pa.array(n), pa.array(least), prefix]
            number += end - first
            yield pa.RecordBatch.from_arrays(columns, ["number", "name", "doc_id", "n_shingles", "least", "prefix"])


def _members(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(member, text) to (member, grams)."""
    for batch in batches:
        for first, end, data, offsets in slices(batch.column(1)):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), _lists(*_sets(data, offsets, words))], ["member", "grams"])


def common(a: np.ndarray, b: np.ndarray, needed: int, parts: int = PARTS) -> int:
    """Common elements of two ordered sets, or 0 if there are fewer than ``needed``.

    The suffix filter first: both are cut at the same elements, and a part has no more in common than its smaller half.
    """
    if min(len(a), len(b)) < needed:
        return 0
    cuts = b[np.arange(1, parts) * len(b) // parts]
    sizes = [np.diff(np.concatenate(([0], np.searchsorted(x, cuts), [len(x)]))) for x in (a, b)]
    if np.minimum(*sizes).sum() < needed:
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    found = int((b[at] == a).sum())
    return found if found >= needed else 0


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b, sizes and shared shingles of both) to the pairs that link."""
    for batch in batches:
        n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
        needed = -(-n * percent // (100 + percent))
        sides = []
        for column in (batch.column(4), batch.column(5)):
            sides.append((column.values.to_numpy(), column.offsets.to_numpy()))
        (left, start), (right, begin) = sides
        links = [
            common(left[start[i] : start[i + 1]], right[begin[i] : begin[i + 1]], k) > 0 for i, k in enumerate(needed.tolist())
        ]
        chosen = pa.array(np.flatnonzero(links))
        yield pa.RecordBatch.from_arrays([batch.column(i).take(chosen) for i in range(2)], ["a", "b"])


def _maybe_wanted(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Those of ``rows`` whose name and id have their bit in a map of the wanted ones, so that few others are shuffled."""
    at = f"pmod(xxhash64(name, doc_id), {MAP_BITS})"
    bits = wanted.selectExpr(f"{at} >> 6 AS word", f"shiftleft(1L, cast({at} & 63 AS int)) AS bit").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    near = rows.withColumn("word", F.expr(f"{at} >> 6")).join(F.broadcast(bits), "word")
    return near.where(f"shiftrightunsigned(bits, cast({at} & 63 AS int)) & 1 = 1").select(rows.columns)


def _needed(a: Column, b: Column, percent: int) -> Column:
    """Shingles that sets of these sizes must share."""
    return F.ceil((a + b) * percent / (100 + percent) - 1e-9)


def components_of(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles and component_id, the smallest doc_id of its component.

    A-Z count as a-z, words are ``[^\\x20\\x09-\\x0D]+``. A text with fewer words than ``words`` has one shingle, all of them; one
    without words, or null, has none and is linked with nothing. Two sets link if 100 * common >= ``percent`` * union. Repeated
    rows get a row each; rows without an id are in components like others, and name one only if it has no id at all (then
    null). Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "jaccard")
    body = F.coalesce(F.col(text_column).cast("binary"), F.lit(b""))
    rows = docs.select(F.unhex(F.md5(body)).alias("name"), F.col(id_column).alias("doc_id"), body.alias("text"))
    schema = f"number bigint, name binary, doc_id {dict(rows.dtypes)['doc_id']}, n_shingles bigint, least bigint, prefix array<bigint>"
    sets = stored(rows.mapInArrow(lambda b: _prefixes(b, words, percent), schema), f"{folder}/sets")

    # 1. sets that may have a partner; a shingle's rows are shuffled once, and counted where they meet
    of_gram = Window.partitionBy("gram")
    grams = sets.select("number", F.explode("prefix").alias("gram")).withColumn("n", F.count(F.lit(1)).over(of_gram))
    met = grams.where("n > 1").groupBy("number").agg(F.count(F.lit(1)).alias("met"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "number")).alias("first")
    some = sets.join(stored(met, f"{folder}/met"), "number").where("met >= least")
    texts = some.groupBy("name").agg(first, F.first("n_shingles").alias("n"))
    texts = stored(texts.select("name", F.col("first.number").alias("member"), F.col("first.doc_id").alias("doc_id"), "n"), f"{folder}/texts")

    # 2. shingles in order, rare ones first
    # equal names are equal texts, so that any row of them will do
    chosen = _maybe_wanted(rows, texts).groupBy("name").agg(F.first("text").alias("text"))
    chosen = chosen.join(texts.select("name", "member").hint("merge"), "name")
    members = chosen.select("member", "text").mapInArrow(lambda b: _members(b, words), "member bigint, grams array<bigint>")
    members = stored(members, f"{folder}/members")
    grams = members.select("member", F.explode("grams").alias("gram")).withColumn("df", F.count(F.lit(1)).over(of_gram)).where("df > 1")
    rarity = F.least(F.floor(F.log2(F.col("df").cast("double"))), F.lit(63)).cast("int")
    key = F.shiftleft(rarity.cast("bigint"), 57).bitwiseOR(F.shiftrightunsigned("gram", 7))
    ordered = grams.groupBy("member").agg(F.sort_array(F.collect_list(key)).alias("shared"))
    ordered = ordered.join(texts.select("member", "n"), "member").where(F.size("shared") * 100 >= F.col("n") * percent)
    ordered = stored(ordered, f"{folder}/ordered")

    # 3. candidates: a place counts the shingles of one set only, which come first
    alone = F.col("n") - F.size("shared")
    length = F.col("n") - F.ceil(F.col("n") * percent / 100 - 1e-9) + 1 - alone
    marks = ordered.where(length > 0).select("member", "n", alone.alias("alone"), F.posexplode(F.slice("shared", 1, length.cast("int"))).alias("at", "bucket"))
    marks = marks.select("bucket", "member", "n", (F.col("alone") + F.col("at")).alias("place"))

    def like(a, b):
        """Sizes allow a link, and so does what both have from this shingle on."""
        needed = _needed(a("n"), b("n"), percent)
        return (F.least(a("n"), b("n")) >= needed) & (F.least(a("n") - a("place"), b("n") - b("place")) >= needed)

    def verify(pairs: DataFrame) -> DataFrame:
        left = ordered.select(F.col("member").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("shared_a"))
        right = ordered.select(F.col("member").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("shared_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "shared_a", "shared_b")
        return both.mapInArrow(lambda b: _verify(b, percent), "a bigint, b bigint")

    _, roots = linked(marks, ["n", "place"], like, verify, f"{folder}/links")

    # components of texts, then of documents
    found = texts.join(roots.withColumnRenamed("node", "member"), "member", "left").withColumn("root", F.coalesce("root", "member"))
    least = stored(found.groupBy("root").agg(F.min("doc_id").alias("component_id")), f"{folder}/least")
    named = stored(found.join(least, "root").select("name", "component_id"), f"{folder}/named")
    out = sets.select("name", "doc_id", "n_shingles").join(named, "name", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


_CLASS = r"[^\x20\x09-\x0D]+"
ORACLE_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_CLASS}') AS w
  FROM documents
),
grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {WORDS - 1}], ' ') AS gram
  FROM words, unnest(range(1, greatest(len(w) - {WORDS - 1}, 1) + 1)) t(i) WHERE len(w) > 0
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * o >= {PERCENT} * (p.n + q.n - o)
),
steps AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT x, y FROM steps
  UNION
  SELECT reach.x, steps.y FROM reach JOIN steps ON steps.x = reach.y
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(r.y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN (SELECT x, min(y) AS y FROM reach GROUP BY x) r ON r.x = d.doc_id
"""
