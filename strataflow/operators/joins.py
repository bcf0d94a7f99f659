"""Inner joins on key columns that hold when one key fills a large part of a table.

A sort-merge join sends all rows of a key to one task. So both key sets are sketched first,
in one job over the key columns alone. A side that is small, counted in rows and bytes, is
broadcast. Otherwise both are sorted and merged, once: the rows of a frequent key are dealt
out over ``SALTS`` parts of that key, and the few matching rows of the other side, counted
as well, go to each part. Where a key has many rows on both sides, its pairs form a grid of
cells: a row of the left goes to all cells of one grid row, a row of the right to all cells
of one grid column, so each pair meets in one cell. Spark's own guess of a size is not asked: it comes from the size
of files, and a table of 0/1 columns is a hundred times larger than its files.

Sketches and counts are Spark jobs that run while the frame is built. The sizes hold for the
rows counted then; build the frame anew when a table has grown.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions.columns import column, quoted

FREQUENT_SHARE = 0.01
"""Part of a table's rows from which a key counts as frequent: at most 100 keys."""

TRACKED_KEYS = 2_000
"""Keys followed by a sketch: its counts are off by less than a thousandth of the rows."""

SKETCH_GROUPS = 256
"""Groups in which the sketches of the tasks are merged before the last step."""

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
"""What may be broadcast, checked by counting, where a join is not told otherwise."""

SALTS = 64
"""Parts of a frequent key, and how often the few rows that match it are repeated."""

CELLS_PER_PARTITION = 4
"""Least cells, by partitions that its pairs fill, of a key that is frequent on both sides, so that no task gets many more than others."""

PAIRS_PER_TASK = 25_000_000
"""Pairs of frequent keys that a task makes on average: more of them make more tasks, not longer ones."""

HELD_ROWS = 256
"""Rows of a cell, on average at most, that a task goes through for each row of the other side: what comes again after few rows is stored small."""


def key_hash(keys: Sequence[str], types: Sequence[T.DataType] | None = None) -> Column:
    """Hash of the keys, as values of ``types`` where given."""
    return F.xxhash64(*[column(k).cast(t) if t else column(k) for k, t in zip(keys, types or [None] * len(keys))])


def common_type(a: T.DataType, b: T.DataType, ansi: bool) -> T.DataType | None:
    """A type in which values hash equally exactly when a join finds them equal, or None."""
    if any(isinstance(t, T.StringType) and t != T.StringType() for t in (a, b)):
        return None  # a collation calls texts equal that differ in bytes
    plain = (T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return T.LongType()
    if a == b:
        return a if isinstance(a, (*plain, T.FractionalType)) else None
    pair = {type(a), type(b)}
    if T.StringType in pair and ansi and any(isinstance(t, T.IntegralType) for t in (a, b)):
        return T.LongType()  # text is read as a number by the join as well
    if pair <= {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if pair <= {T.ByteType, T.ShortType, T.IntegerType, T.DoubleType}:
        return T.DoubleType()
    if T.DecimalType in pair and all(isinstance(t, (T.DecimalType, T.IntegralType)) for t in (a, b)):
        digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
        shapes = [(t.precision, t.scale) if isinstance(t, T.DecimalType) else (digits[type(t)], 0) for t in (a, b)]
        scale = max(s for _, s in shapes)
        whole = max(p - s for p, s in shapes)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def common_types(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[T.DataType] | None:
    """A common type for each key, or None if equal keys may hash differently."""
    ansi = left.sparkSession.conf.get("spark.sql.ansi.enabled") == "true"
    types = [common_type(left.schema[k].dataType, right.schema[k].dataType, ansi) for k in keys]
    return None if None in types else types


@dataclass(frozen=True)
class KeySketch:
    """Rows of a frame, and hashes of the keys that hold at least a given share of them."""

    rows: int
    frequent: list[int]


def sketch_keys(
    frames: Sequence[DataFrame],
    keys: Sequence[str],
    share: float = FREQUENT_SHARE,
    types: Sequence[T.DataType] | None = None,
) -> list[KeySketch]:
    """One job that reads only the key columns and shuffles only sketches of fixed size, merged in two steps.

    Two keys with equal hashes are routed alike, which changes no result.
    """
    most = int(1 / share) + 1
    tracked = max(TRACKED_KEYS, most)
    group = F.spark_partition_id() % SKETCH_GROUPS
    sketches = [
        df.select(key_hash(keys, types).alias("h"), group.alias("group"))
        .groupBy("group")
        .agg(F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("sketch"), F.count("*").alias("n"))
        .groupBy(F.lit(i).alias("frame"))
        .agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("n"))
        .select("frame", F.expr(f"approx_top_k_estimate(sketch, {most})").alias("top"), "n")
        for i, df in enumerate(frames)
    ]
    # an empty frame has no row here
    found = [KeySketch(0, []) for _ in frames]
    for row in reduce(DataFrame.union, sketches).collect():
        least = max(share * row["n"], 2)
        found[row["frame"]] = KeySketch(row["n"], [e["item"] for e in row["top"] if e["count"] >= least])
    return found


def row_bytes(schema: T.StructType) -> Column:
    """About the size of a row: eight bytes per column and the length of what has one."""
    size = F.lit(8 * len(schema)).cast("bigint")
    for field in schema:
        if not isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)):
            text = column(field.name)
            if not isinstance(field.dataType, (T.StringType, T.BinaryType)):
                text = F.to_json(F.struct(text))
            size = size + F.coalesce(F.octet_length(text), F.lit(0))
    return size


def may_broadcast(df: DataFrame, rows: int | None = None, size: int | None = None) -> bool:
    """Count rows and bytes of a frame that is expected to be small."""
    rows = BROADCAST_ROWS if rows is None else rows
    size = BROADCAST_BYTES if size is None else size
    found = df.agg(F.count("*").alias("n"), F.sum(row_bytes(df.schema)).alias("bytes")).first()
    return found["n"] <= rows and (found["bytes"] or 0) <= size


def repeatable_hashes(
    df: DataFrame, keys: Sequence[str], types: Sequence[T.DataType], hashes: list[int], rows: int, size: int
) -> list[int]:
    """As many of the key hashes as have rows that may be repeated ``SALTS`` times, those with few rows first."""
    h = key_hash(keys, types)
    matching = df.filter(h.isin(hashes))
    sizes = matching.groupBy(h.alias("h")).agg(F.count("*").alias("n"), F.sum(row_bytes(df.schema)).alias("bytes"))
    # one row per frequent key
    found = {row["h"]: (row["n"], row["bytes"]) for row in sizes.collect()}
    chosen, count, length = [], 0, 0
    for value in sorted(hashes, key=lambda k: found.get(k, (0, 0))):
        n, width = found.get(value, (0, 0))
        count, length = count + n, length + width
        if count > rows or length > size:
            break
        chosen.append(value)
    return chosen


def matching_rows(
    left: DataFrame, right: DataFrame, keys: Sequence[str], types: Sequence[T.DataType], hashes: list[int]
) -> dict[int, tuple[int, int]]:
    """Rows of both sides for each of the key hashes that both have."""
    h = key_hash(keys, types)
    sides = [df.filter(h.isin(hashes)).select(h.alias("h"), F.lit(i).alias("side")) for i, df in enumerate((left, right))]
    of_left = F.count(F.when(F.col("side") == 0, 1))
    found = sides[0].union(sides[1]).groupBy("h").agg(of_left.alias("m"), (F.count("*") - of_left).alias("n"))
    # one row per frequent key
    return {row["h"]: (row["m"], row["n"]) for row in found.collect() if row["m"] and row["n"]}


def _known_partitioning(left: DataFrame, right: DataFrame, keys: Sequence[str], types: Sequence[T.DataType]) -> list[Column] | None:
    """Keys as a join compares them, so that rows dealt out by them need no second shuffle; None where a join changes them."""
    for key, kind in zip(keys, types):
        sides = {left.schema[key].dataType, right.schema[key].dataType}
        if isinstance(kind, (T.FloatType, T.DoubleType)) or len(sides) > 1 and not all(isinstance(t, T.IntegralType) for t in sides):
            return None
    wide = {k: {left.schema[k].dataType, right.schema[k].dataType} for k in keys}
    return [column(k) if len(wide[k]) == 1 else column(k).cast(max(wide[k], key=lambda t: _WIDTHS[type(t)])) for k in keys]


_WIDTHS = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8}


def grid_shape(m: int, n: int, partitions: int) -> tuple[int, int]:
    """Rows and columns, powers of two, of the grid for m left and n right rows of a key.

    There are at least ``SALTS`` cells and ``CELLS_PER_PARTITION`` for each partition. Left rows are repeated once per
    column, right rows once per row; of all shapes with that many cells this one repeats least.
    """
    cells = 1
    while cells < max(SALTS, CELLS_PER_PARTITION * partitions):
        cells *= 2
    heights = [1 << i for i in range(cells.bit_length())]
    height = min(heights, key=lambda r: m * (cells // r) + n * r)
    return height, cells // height


def short_rounds(shape: tuple[int, int], m: int, n: int, hold_left: bool) -> tuple[int, int]:
    """``shape`` with at most about ``HELD_ROWS`` rows of the held side in a cell, and about as many cells as it had where that is enough.

    The result has a run of each row of the other side, and the rows of the held side again and again. A file keeps both small
    while a round is short; long rounds made each row of the result larger the larger the tables were. The other side is repeated for it
    as often as there are parts, which is at most one row for ``HELD_ROWS`` / 2 of the result.
    """
    rows, parts = (m, shape[0]) if hold_left else (n, shape[1])
    while parts * HELD_ROWS < rows:
        parts *= 2
    others = max(1, shape[0] * shape[1] // parts)
    return (parts, others) if hold_left else (others, parts)


def join_on_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    handle_frequent: bool = True,
    key_frames: tuple[DataFrame, DataFrame] | None = None,
    broadcast_rows: int | None = None,
    broadcast_bytes: int | None = None,
    sketches: tuple[KeySketch, KeySketch] | None = None,
) -> DataFrame:
    """All columns of ``left`` and ``columns`` of ``right`` for equal, non-null keys.

    SQL inner join: a key that occurs m times on the left and n times on the right gives
    m * n rows, so one of the sides should have each key once. ``handle_frequent`` reads
    the key columns of both sides once more beforehand, from ``key_frames`` where those
    hold the keys (and maybe more) at less cost, unless ``sketches`` of them are given. A key with many rows on both sides
    is joined in a grid of cells (``grid_shape``): each row is repeated about as often as the square root of their number. Their pairs
    are counted, and the rows dealt out over as many tasks as leave ``PAIRS_PER_TASK`` for each: the result may grow with the
    square of the input, the work of a task does not. Keys with a collation, and pairs of types without a common one, are joined without salt.
    """
    keys = list(keys)
    rows = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    size = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    extra = list(columns) if columns is not None else [c for c in right.columns if c not in keys]
    left = complete_keys(left, keys)
    right = complete_keys(right, keys).select([column(c) for c in [*keys, *extra]])
    if not handle_frequent:
        return _inner(left, right, keys, extra)
    types = common_types(left, right, keys)
    if sketches is None:
        sketches = tuple(sketch_keys([complete_keys(df, keys) for df in key_frames or (left, right)], keys, types=types))
    if sketches[1].rows <= rows and may_broadcast(right, rows, size):
        return _inner(left, F.broadcast(right), keys, extra)
    if sketches[0].rows <= rows and may_broadcast(left, rows, size):
        return _inner(F.broadcast(left), right, keys, extra)
    if types is None or not (sketches[0].frequent or sketches[1].frequent):
        return _inner(left, right.hint("merge"), keys, extra)
    # what is only repeated has SALTS parts: keys with more pairs than these should make are counted for a grid
    few = [min(rows, SALTS * PAIRS_PER_TASK // max(s.rows, 1)) for s in sketches]
    hot_left = repeatable_hashes(right, keys, types, sketches[0].frequent, few[0], size) if sketches[0].frequent else []
    of_right = [h for h in sketches[1].frequent if h not in hot_left]
    hot_right = repeatable_hashes(left, keys, types, of_right, few[1], size) if of_right else []
    shapes = {(SALTS, 1): hot_left, (1, SALTS): hot_right}
    both = [h for h in {*sketches[0].frequent, *sketches[1].frequent} if h not in {*hot_left, *hot_right}]
    tasks = 0
    hold_left = len(extra) > len(left.columns) - len(keys)  # the side with more to repeat is gone through once
    if both and (found := matching_rows(left, right, keys, types, both)):
        pairs = sum(m * n for m, n in found.values())
        tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs // PAIRS_PER_TASK))
        for h, (m, n) in found.items():
            shapes.setdefault(short_rounds(grid_shape(m, n, -(-tasks * m * n // pairs)), m, n, hold_left), []).append(h)
    shapes = {shape: hashes for shape, hashes in shapes.items() if hashes}
    if not shapes:
        return _inner(left, right.hint("merge"), keys, extra)
    salt = "__salt"
    while salt in left.columns or salt in right.columns:
        salt += "_"
    cells = [_in_cells(df, keys, types, shapes, salt, side) for side, df in enumerate((left, right))]
    if tasks and (dealt := _known_partitioning(left, right, keys, types)):
        # a number that is given holds: by the bytes of its input alone, Spark would make few tasks of many pairs
        cells = [df.repartition(tasks, *dealt, salt) for df in cells]
    return _inner(cells[0], cells[1].hint("merge"), keys, extra, salt, hold_left and tasks > 0)


def join_column(left: DataFrame, right: DataFrame, keys: Sequence[str], name: str, **options) -> DataFrame:
    """``left`` with one column of ``right``, as in joining labels or predictions."""
    return join_on_keys(left, right, keys, [name], **options)


def complete_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that can match at all; a null key that fills a table is gone before the shuffle."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & column(key).isNotNull()
    return df.filter(condition)


def _in_cells(
    df: DataFrame, keys: list[str], types: Sequence[T.DataType], shapes: dict[tuple[int, int], list[int]], salt: str, side: int
) -> DataFrame:
    """Each row once for every cell it belongs to: by its content in one row (side 0) or column (side 1) of its key's grid.

    Cells are numbered row by row. Keys without a grid have one cell.
    """
    h = key_hash(keys, types)
    # only what has an order can be hashed; maps count as text
    content = F.xxhash64(*[column(f.name) if _hashable(f.dataType) else F.to_json(F.struct(column(f.name))) for f in df.schema])
    cells = F.array(F.lit(0))
    for (height, width), hashes in shapes.items():
        first, step, count = (width, 1, width) if side == 0 else (1, width, height)
        own = F.pmod(content, F.lit(height if side == 0 else width)).cast("int") * first
        cells = F.when(h.isin(hashes), F.sequence(own, own + (count - 1) * step, F.lit(step))).otherwise(cells)
    return df.withColumn(salt, F.explode(cells))


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _inner(left: DataFrame, right: DataFrame, keys: list[str], extra: list[str], salt: str | None = None, hold_left: bool = False) -> DataFrame:
    """A sort-merge join holds the rows of a key of its second side."""
    a, b = left.alias("a"), right.alias("b")
    condition = F.lit(True)
    for key in map(quoted, [*keys, *([salt] if salt else [])]):
        condition = condition & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    kept = [F.col(f"a.{quoted(c)}") for c in left.columns if c != salt]
    return (b.join(a, condition, "inner") if hold_left else a.join(b, condition, "inner")).select(*kept, *[F.col(f"b.{quoted(c)}") for c in extra])
