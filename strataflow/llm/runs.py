"""Periodic runs of words, found by a suffix automaton whose link tree is recoloured with link-cut access.

A run is a stretch of words with smallest period q, of at least ``LEAST`` words and ``EXPONENT`` * q, that neither neighbour
extends. The words of a stretch are appended to a suffix automaton. Its suffix links form a tree in which the path from
the state of a prefix to the root holds all its suffixes. Each state is coloured by the last end of its strings: appending
the word at i colours that path i, and the path falls into segments that had one colour each (a preferred path of a
link-cut tree). A segment of colour c whose longest string has n words says that the last n words ended at c before; where
i - c <= n these are two copies in a row or overlapping, a square of period i - c that starts at c - n + 1 and goes on for as many
words as it is met again. Each access takes amortised logarithmic time, whatever the period.

Most words stand in no run, so stretches where none can lie are left out before, by a condition that each run meets (see
``stretches``). What is in a run is decided by the automaton alone, on the words themselves.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.arrays import mix, owners, slices, word_hashes

LEAST = 6
EXPONENT = 4
_ODD = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]
"""Start, length and period, in words."""


def automaton(words: list) -> tuple[list[int], list[int], list[int]]:
    """Length of the longest string and suffix link of each state, and the state of each prefix. State 0 is the root."""
    length, link, moves = [0], [-1], [{}]
    last, prefix = 0, []
    for word in words:
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        moves.append({})
        at = last
        while at >= 0 and word not in moves[at]:
            moves[at][word] = new
            at = link[at]
        if at >= 0:
            target = moves[at][word]
            if length[target] == length[at] + 1:
                link[new] = target
            else:
                twin = len(length)
                length.append(length[at] + 1)
                link.append(link[target])
                moves.append(moves[target].copy())
                while at >= 0 and moves[at].get(word) == target:
                    moves[at][word] = twin
                    at = link[at]
                link[target] = link[new] = twin
        last = new
        prefix.append(new)
    return length, link, prefix


class LastEnds:
    """The last end of the strings of each state, as colours of preferred paths.

    Each preferred path is a splay tree ordered by depth with one colour, which is kept at the root of its tree. Nodes
    count from 1, 0 is none.
    """

    def __init__(self, link: list[int]):
        self.up = [0, *(p + 1 for p in link)]  # the parent in the splay tree; of its root, the parent of the path's top
        self.left = [0] * len(self.up)
        self.right = [0] * len(self.up)
        self.colour = [-1] * len(self.up)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            child = left[p] = right[x]
            right[x] = p
        else:
            child = right[p] = left[x]
            left[x] = p
        if child:
            up[child] = p
        up[p], up[x] = x, g
        if left[g] == p:
            left[g] = x
        elif right[g] == p:
            right[g] = x
        else:  # x is the root now
            self.colour[x] = self.colour[p]

    def _splay(self, x: int) -> None:
        up, left, right, rotate = self.up, self.left, self.right, self._rotate
        p = up[x]
        while left[p] == x or right[p] == x:
            g = up[p]
            if left[g] == p or right[g] == p:
                rotate(p if (left[g] == p) == (left[p] == x) else x)
            rotate(x)
            p = up[x]

    def recolour(self, state: int, end: int) -> Iterator[tuple[int, int]]:
        """Colour the path from ``state`` to the root with ``end``; yields its segments: their colour before, and their deepest state."""
        up, right, colour = self.up, self.right, self.colour
        x, below = state + 1, 0
        while x:
            self._splay(x)
            before = colour[x]
            if before >= 0:
                yield before, x - 1
            if right[x]:
                colour[right[x]] = before  # what lies deeper keeps its colour as a path of its own
            right[x] = below
            if below:
                up[below] = x
            below, x = x, up[x]
        colour[below] = end
        self._splay(state + 1)


def runs(words: list, least: int = LEAST, exponent: int = EXPONENT) -> list[Run]:
    """All runs of a sequence, by start and then period. ``exponent`` is 4 at least, so that each run is met with its own period."""
    length, link, prefix = automaton(words)
    ends = LastEnds(link)
    last: dict[tuple[int, int], int] = {}
    for end, state in enumerate(prefix):
        for before, deepest in ends.recolour(state, end):
            if end - before <= length[deepest]:
                last[before - length[deepest] + 1, end - before] = end
    found = ((start, end - start + 1, period) for (start, period), end in last.items())
    return sorted((s, n, q) for s, n, q in found if n >= max(least, exponent * q))


def _together(mask: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of at least ``least`` true values."""
    edges = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = end - begin >= least
    return begin[long], end[long]


def stretches(hashes: np.ndarray, bounds: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int]]:
    """Stretches of words, within a text each, that hold all runs and the words beside them.

    In a run of period q each word but the first q stands again at a distance of at most q. So for each power of two m,
    runs of a period from m to 2m - 1 lie in (exponent - 1) * m consecutive words with an equal one less than 2m words before.
    """
    n = len(hashes)
    if n < least:
        return []
    own = owners(bounds)
    key = mix(hashes + own.astype(np.uint64) * _ODD)
    order = np.argsort(key, kind="stable")
    again = key[order[1:]] == key[order[:-1]]
    distance = np.full(n, n, dtype=np.int64)
    distance[order[1:][again]] = (order[1:] - order[:-1])[again]
    marks = np.zeros(n + 1, dtype=np.int32)
    longest, m = int(np.diff(bounds).max()), 1
    while max(least, exponent * m) <= longest:
        # a stretch is cut where a text begins, as its first words have none before them
        begin, end = _together(distance < 2 * m, max(least - 2 * m + 1, (exponent - 1) * m))
        np.add.at(marks, np.maximum(begin - 2 * m, bounds[own[begin]]), 1)
        np.add.at(marks, np.minimum(end + 1, bounds[own[end - 1] + 1]), -1)
        m *= 2
    begin, end = _together(np.cumsum(marks[:-1]) > 0, 1)
    out = []
    for b, e in zip(begin.tolist(), end.tolist()):  # stretches of neighbouring texts may touch
        cuts = bounds[own[b] + 1 : own[e - 1] + 1].tolist()
        out += [(s, t) for s, t in zip([b, *cuts], [*cuts, e]) if t - s >= least]
    return out


def without_runs(words: list, found: list[Run]) -> list:
    """The words that are in no run, or among the first of each run that holds them, as many as its period."""
    keep = np.ones(len(words), dtype=bool)
    for start, size, period in found:
        keep[start + period : start + size] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch], columns: int, least: int, exponent: int) -> Iterator[pa.RecordBatch]:
    """Columns and a text, to the columns, the runs of the text, and the text without them."""
    for batch in batches:
        for first, end, data, offsets in slices(batch.column(columns)):
            hashes, bounds = word_hashes(data, offsets)
            raw, cuts = data.tobytes(), offsets.tolist()
            texts = [raw[b:e].split() for b, e in zip(cuts, cuts[1:])]  # bytes are split at the same characters as words
            found: list[list[Run]] = [[] for _ in texts]
            for b, e in stretches(hashes, bounds, least, exponent):
                text = int(np.searchsorted(bounds, b, side="right")) - 1
                base = int(bounds[text])
                found[text] += [(s + b - base, n, q) for s, n, q in runs(texts[text][b - base : e - base], least, exponent)]
            kept = [b" ".join(without_runs(t, f) if f else t) for t, f in zip(texts, found)]
            rows = [[{"start": s, "length": n, "period": q} for s, n, q in sorted(f)] for f in found]
            arrays = [batch.column(i).slice(first, end - first) for i in range(columns)]
            arrays += [pa.array(rows, RUNS), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, [f"c{i}" for i in range(columns)] + ["runs", "collapsed"])


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST, exponent: int = EXPONENT
) -> DataFrame:
    """One row per row of ``docs``: doc_id, runs (start, length and period in words, by start and then period), and the text without them.

    Words are ``[^\\x20\\x09-\\x0D]+`` and compared byte by byte. ``collapsed`` has the words that are in no run, or among the first
    of it (as many as its period), joined by one blank. A null text has no words, like an empty one. Rows that
    repeat, or have no id, get a row each. Other columns of ``docs`` are not read. Nothing is shuffled; a text is held by one task, with
    some hundred bytes for each word of its longest stretch that may hold a run.
    """
    if exponent < 4:
        raise ValueError("runs of fewer than four periods are not met at each of their ends")
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    schema = f"c0 {dict(rows.dtypes)['doc_id']}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary"
    found = rows.mapInArrow(lambda b: _scan(b, 1, least, exponent), schema)
    return found.select(F.col("c0").alias("doc_id"), "runs", F.col("collapsed").cast("string").alias("collapsed"))


def planted(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text) in which every tenth document by the checksum of its id repeats its words from some place on.

    With h the checksum, g = floor(h / 10) and n words, each word i >= a becomes the word a + (i - a) % p of the text, where a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)). A text that is changed has one blank between words. Documents without an id, and those
    without words, stay as they are.
    """
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    rows = rows.withColumn("words", F.when(checksum % 10 == 0, words)).withColumn("g", F.floor(checksum / 10).cast("bigint"))
    n = F.size("words").cast("bigint")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    rows = rows.withColumn("p", F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    changed = F.transform("words", lambda w, i: F.get("words", place(i).cast("int")))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def run_counts(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_runs, the longest run (start, length, period, exponent_milli), and digests of runs and of the text left.

    Of equally long runs that with the smallest start counts, then that with the smallest period; without a run it is four nulls.
    """
    rows = periodic_runs(docs, **options)
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    rows = rows.select("doc_id", "runs", longest.alias("longest"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    period = -F.col("longest.p")
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("longest.s")).alias("start"), F.col("longest.length").alias("length"),
        period.alias("period"), F.floor(F.lit(1000) * F.col("longest.length") / period).cast("bigint").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


_STEP = "list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))"
_CHECKSUM = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: {_STEP.replace("x,", "xor(crc, byte),", 1)}), 4294967295)"""
# Pairs of equal words at each distance, put together to stretches; the checksum bit by bit.
ORACLE_SQL = rf"""
WITH base AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_CHECKSUM} AS h FROM documents
),
cut AS (SELECT doc_id, w, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM base),
texts AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w
    ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w
  FROM cut
),
words AS MATERIALIZED (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word FROM texts),
equal AS (
  SELECT x.doc_id, y.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i
  WHERE greatest({LEAST}, {EXPONENT} * (y.i - x.i)) <= x.n
),
long AS (
  SELECT doc_id, q, min(i) - q AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM equal) GROUP BY doc_id, q, g
  HAVING count(*) + q >= greatest({LEAST}, {EXPONENT} * q)
),
runs AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM long GROUP BY ALL),
told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
    arg_min((start, length, period), (-length, start, period)) AS best
  FROM runs GROUP BY doc_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS text FROM words w ANTI JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i GROUP BY w.doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best[1] AS start, best[2] AS length, best[3] AS period,
  1000 * best[2] // best[3] AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN told t ON t.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
