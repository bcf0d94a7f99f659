"""Centroid clustering of integer vectors by bit planes and popcounts.

The 64 components of a vector are integers in two's complement. Plane b of it is one 64-bit number that holds bit b of each
component; it has the weight 2**b, the last one, of the signs, the negative of that. The dot product of two vectors is the sum over
pairs of their planes of both weights times the number of bits set in the AND of the planes, and with the squared norms it gives
the squared distance. All of it is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.graph import stored
from strataflow.sources import scratch_path

COMPONENTS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
#: Components are below 2**LARGEST_BITS, so that a squared distance fits into 63 bits.
LARGEST_BITS = 27
#: Vectors times centroids compared at once.
BLOCK = 1 << 17


def weights(planes: int) -> np.ndarray:
    out = np.left_shift(np.int64(1), np.arange(planes, dtype=np.int64))
    out[-1:] *= -1
    return out


def to_planes(vectors: np.ndarray) -> np.ndarray:
    """(n, 64) integers to (n, planes) unsigned numbers, as many planes as the largest component needs, and its sign."""
    largest = int(np.maximum(vectors, ~vectors).max(initial=0))
    planes = np.arange(largest.bit_length() + 1)
    bits = (vectors[:, None, :] >> planes[:, None] & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little").view("<u8").reshape(len(vectors), len(planes))


def from_planes(planes: np.ndarray) -> np.ndarray:
    """The integers of which ``planes`` are the planes."""
    n, count = planes.shape
    bits = np.unpackbits(np.ascontiguousarray(planes, "<u8").view(np.uint8).reshape(n, count, 8), axis=2, bitorder="little")
    out = np.zeros((n, COMPONENTS), dtype=np.int64)
    for b, weight in enumerate(weights(count).tolist()):
        out += bits[:, b].astype(np.int64) * weight
    return out


def dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dot products of all rows of ``left`` with all of ``right``, both given as planes."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    for i, outer in enumerate(weights(left.shape[1]).tolist()):
        for j, inner in enumerate(weights(right.shape[1]).tolist()):
            out += np.bitwise_count(left[:, i, None] & right[None, :, j]).astype(np.int64) * (outer * inner)
    return out


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each vector, of equally near ones the smaller, and the squared distance."""
    number = np.zeros(len(planes), dtype=np.int64)
    distance = np.zeros(len(planes), dtype=np.int64)
    right = to_planes(centroids)
    norms = (centroids * centroids).sum(axis=1)
    width = weights(planes.shape[1])
    step = max(BLOCK // max(len(centroids), 1), 1)
    for first in range(0, len(planes), step):
        part = planes[first : first + step]
        own = np.zeros(len(part), dtype=np.int64)
        for i in range(len(width)):
            for j in range(len(width)):
                own += np.bitwise_count(part[:, i] & part[:, j]).astype(np.int64) * (width[i] * width[j])
        away = own[:, None] + norms - 2 * dots(part, right)
        number[first : first + step] = away.argmin(axis=1)
        distance[first : first + step] = away.min(axis=1)
    return number, distance


def _pack(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """(vec_id, components) to (vec_id, planes as bytes)."""
    for batch in batches:
        values = pc.list_flatten(batch.column(1)).cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, COMPONENTS)
        scaled = np.floor(values * scale)
        if len(scaled) and not np.abs(scaled).max() < 1 << LARGEST_BITS:
            raise ValueError(f"a component times {scale} is beyond 2**{LARGEST_BITS}: its distance would not fit into a bigint")
        planes = to_planes(scaled.astype(np.int64))
        size = planes.shape[1] * 8
        ends = pa.py_buffer(np.arange(0, len(planes) * size + 1, size, dtype=np.int32))
        column = pa.Array.from_buffers(pa.binary(), len(planes), [None, ends, pa.py_buffer(np.ascontiguousarray(planes, "<u8"))])
        yield pa.RecordBatch.from_arrays([batch.column(0), column], ["vec_id", "planes"])


def _planes(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and planes of a batch, for each number of planes."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        raw = b"".join(column.take(pa.array(rows)).to_pylist())
        yield rows, np.frombuffer(raw, "<u8").reshape(len(rows), size // 8)


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per cluster with vectors in the task: cluster, how many, and the sums of their components."""
    counts = np.zeros(len(centroids), dtype=np.int64)
    sums = np.zeros((len(centroids), COMPONENTS), dtype=np.int64)
    for batch in batches:
        for _, planes in _planes(batch.column(1)):
            number, _ = nearest(planes, centroids)
            order = np.argsort(number, kind="stable")
            there, begin = np.unique(number[order], return_index=True)
            sums[there] += np.add.reduceat(from_planes(planes[order]), begin, axis=0)
            counts += np.bincount(number, minlength=len(counts))
    there = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(there), pa.array(counts[there]), pa.array(list(sums[there]), pa.list_(pa.int64()))], ["cluster", "n", "sums"]
    )


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        number = np.zeros(batch.num_rows, dtype=np.int32)
        distance = np.zeros(batch.num_rows, dtype=np.int64)
        for rows, planes in _planes(batch.column(1)):
            number[rows], distance[rows] = nearest(planes, centroids)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number), pa.array(distance)], ["vec_id", "cluster", "distance"])


def _integers(rows: list, at: str) -> np.ndarray:
    return np.array([from_planes(np.frombuffer(r[at], "<u8")[None])[0] for r in rows], dtype=np.int64).reshape(-1, COMPONENTS)


def cluster(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: str = "2",
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) for each vector that is kept, and the final centroids, a row for each.

    Vectors with another number of components than 64, or with one that is null or not finite, are left out. A component x
    is the integer floor(``scale`` * x); one of 2**27 and more raises. The first centroids are the ``clusters`` vectors with
    the smallest SHA-256 of "``seed``:id", of equal ids those with the smaller planes; with fewer vectors there are fewer. A null id counts as empty
    text. A vector goes to the nearest centroid, of equally near ones to that with the smaller number; a centroid becomes
    the floor of the mean of its vectors, and stays where it has none. Repeated rows get a row each.

    To the driver come one row per cluster of sums a round, and ``clusters`` vectors at first. Centroids go to the tasks with their code.
    """
    folder = scratch_path(vectors.sparkSession, "clusters")
    value = F.col(vector_column)
    good = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where((F.size(value) == COMPONENTS) & good)
    rows = rows.select(F.col(id_column).alias("vec_id"), value.cast("array<double>").alias("value"))
    kind = dict(rows.dtypes)["vec_id"]
    packed = stored(rows.mapInArrow(lambda b: _pack(b, scale), f"vec_id {kind}, planes binary"), f"{folder}/packed")

    luck = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    centroids = _integers(packed.select(luck.alias("luck"), "planes").orderBy("luck", "planes").limit(clusters).collect(), "planes")
    for _ in range(rounds):
        now = centroids.copy()
        parts = packed.mapInArrow(lambda b, c=now: _sums(b, c), "cluster bigint, n bigint, sums array<bigint>")
        totals = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(COMPONENTS)]
        for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *totals).collect():
            centroids[row.cluster] = [row[f"s{i}"] // row.n for i in range(COMPONENTS)]
    found = packed.mapInArrow(lambda b: _assigned(b, centroids), f"vec_id {kind}, cluster int, distance bigint")
    return stored(found, f"{folder}/assigned"), centroids


def cluster_report(vectors: DataFrame, **options) -> DataFrame:
    """One row per vector that is kept: vec_id, cluster, distance, inertia of its cluster and of all, and a digest of its centroid."""
    found, centroids = cluster(vectors, **options)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    spent = {r.cluster: r.total for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    about = [(c, total, sum(spent.values()), digest[c]) for c, total in spent.items()]
    kinds = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    about = found.sparkSession.createDataFrame(about, kinds)  # one row per cluster
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    """The rounds one after the other, distances component by component."""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR)) - 1 AS cluster, v FROM kept
  QUALIFY cluster < {CLUSTERS}
)""",
    ]
    for i in range(ROUNDS + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT row, any_value(vec_id) AS vec_id, any_value(k.v) AS v,
    min(list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT * {CLUSTERS} + cluster) AS best
  FROM kept k, c{i} c GROUP BY row
)""")
        if i < ROUNDS:
            parts.append(f"""m{i} AS (
  SELECT best % {CLUSTERS} AS cluster, nth, sum(v[nth])::BIGINT AS s, count(*) AS n FROM a{i}, range(1, {COMPONENTS + 1}) t(nth) GROUP BY ALL
),
c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(n.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY nth) AS v FROM m{i} GROUP BY cluster
  ) n ON n.cluster = c.cluster
)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, (best % {CLUSTERS})::INTEGER AS cluster, best // {CLUSTERS} AS distance,
  sum(best // {CLUSTERS}) OVER (PARTITION BY best % {CLUSTERS})::BIGINT AS cluster_inertia,
  sum(best // {CLUSTERS}) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.cluster = best % {CLUSTERS}
"""


ORACLE_SQL = _oracle()
