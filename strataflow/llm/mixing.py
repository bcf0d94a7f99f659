"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Rows of a source are cut into blocks. A source of weight w out of W has one block for each of its windows: block j is
released at slot floor(j W / w) and due at slot ceil((j + 1) W / w), and each slot takes the released block that is due
first. After any number of slots every source that has blocks left is less than one block away from its share. The
schedule repeats after W slots, so only those are scheduled one by one, and a row finds its slot by arithmetic.

Weights are whole numbers, so windows are exact and no error grows from cycle to cycle. Given weights are turned into whole
numbers of the same proportions; if that takes more than ``MAX_SLOTS`` slots they are refused, not rounded.
"""

from __future__ import annotations

from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.sources import scratch_path

BLOCK_ROWS = 32
#: Least slots between two blocks of a source that the given weights do not name.
CYCLE = 500
#: Most slots in a cycle of the sources that weights name: what is scheduled one by one, in one row.
MAX_SLOTS = 100_000
BUCKET_ROWS = 2_000
#: Schedules of at most so many slots are broadcast, larger ones joined by key.
BROADCAST_SLOTS = 100_000
_CHUNK = 512


def _key(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def whole_weights(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers of the same proportions. A float counts as the simplest fraction that has its value: 1 / 3 is a third."""

    def fraction(weight: float) -> Fraction:
        exact = Fraction(weight)
        near = (exact.limit_denominator(10**digits) for digits in range(17))
        return next((f for f in near if float(f) == weight), exact)

    if any(not 0 <= w < float("inf") for w in weights.values()):
        raise ValueError("weights must be finite and not negative")
    parts = {name: fraction(w) for name, w in weights.items()}
    common = lcm(*(f.denominator for f in parts.values()))
    whole = {name: int(f * common) for name, f in parts.items()}
    least = gcd(*whole.values()) or 1
    whole = {name: w // least for name, w in whole.items()}
    if sum(whole.values()) > MAX_SLOTS:
        raise ValueError(f"the weights repeat after {sum(whole.values())} slots, more than {MAX_SLOTS}; give rounder ones")
    return whole


def target_weights(sizes: DataFrame, weights: dict[str, float] | None, cycle: int) -> DataFrame:
    """(key, n, weight): whole weights, at least 1.

    Without ``weights`` a source counts with the square root of its rows to the nearest whole number, so that large ones do not
    crowd out small ones; all roots are divided by one number if they sum to more than ``MAX_SLOTS``. Given weights
    keep their proportions. A source that they do not name, or name with 0, has one block in at least ``cycle`` slots.
    """
    every = Window.partitionBy()  # one row per source
    if weights is None:
        root = F.sqrt(F.col("n").cast("double"))
        parts = F.ceil(F.sum(root).over(every) / MAX_SLOTS)
        return sizes.select("key", "n", F.greatest(F.lit(1), F.round(root / parts)).cast("bigint").alias("weight"))
    whole = whole_weights(weights)
    named = F.create_map(*(x for name, w in whole.items() for x in (F.lit("=" + name), F.lit(w).cast("bigint")))) if whole else F.create_map()
    wish = F.coalesce(F.try_element_at(named, F.col("key")), F.lit(0).cast("bigint")) if whole else F.lit(0).cast("bigint")
    total, others = F.sum("wish").over(every), F.sum((F.col("wish") == 0).cast("int")).over(every)
    times = F.when((total > 0) & (others > 0), F.ceil(F.lit(cycle) / F.greatest(total, F.lit(1)))).otherwise(F.lit(1))
    return sizes.withColumn("wish", wish).select("key", "n", F.greatest(F.lit(1), F.col("wish") * times).cast("bigint").alias("weight"))


def schedule(weights: DataFrame) -> DataFrame:
    """(key, slots, n, weight, j, release, deadline, slot) for all blocks of one cycle, earliest deadline first.

    Blocks are taken by deadline, ties by key, and each gets the first free slot from its release on: what is due
    later cannot take a slot from what is due earlier, so this is the order of earliest deadlines without asking all sources
    at each slot. Free slots before the last taken one are kept in a list; there are fewer of them than sources.
    """
    one = weights.agg(F.array_sort(F.collect_list(F.struct("key", "n", "weight"))).alias("sources"), F.sum("weight").alias("slots"))
    blocks = one.select("slots", F.posexplode("sources").alias("i", "source")).select("slots", "i", "source.*")
    blocks = blocks.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("weight") - 1)).alias("j"))
    release = F.floor(F.col("j") * F.col("slots") / F.col("weight")).cast("bigint").alias("release")
    deadline = F.ceil((F.col("j") + 1) * F.col("slots") / F.col("weight")).cast("bigint").alias("deadline")
    by_deadline = F.struct(deadline, "i", "j", release, "key", "slots", "n", "weight")
    ordered = blocks.agg(F.array_sort(F.collect_list(by_deadline)).alias("blocks"))

    def take(state: Column, block: Column) -> Column:
        later = F.filter(state["free"], lambda s: s >= block["release"])
        slot = F.coalesce(F.get(later, 0), F.greatest(state["end"], block["release"]))
        passed = F.when(slot > state["end"], F.sequence(state["end"], slot - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(
            F.array(F.struct(slot.alias("slot"), passed.alias("passed"))),
            lambda found: F.struct(
                F.concat(F.filter(state["free"], lambda s: s != found["slot"]), found["passed"]).alias("free"),
                F.greatest(state["end"], found["slot"] + 1).alias("end"),
                F.array_append(state["taken"], found["slot"]).alias("taken"),
            ),
        )[0]

    def take_chunk(state: Column, chunk: Column) -> Column:
        start = F.struct(state["free"].alias("free"), state["end"].alias("end"), F.array().cast("array<bigint>").alias("taken"))
        return F.transform(
            F.array(F.aggregate(chunk, start, take)),
            lambda after: F.struct(
                after["free"].alias("free"), after["end"].alias("end"), F.array_append(state["taken"], after["taken"]).alias("taken")
            ),
        )[0]

    # the list of slots grows by chunks, since appending copies it
    last = F.greatest(F.floor((F.size("blocks") - 1) / _CHUNK), F.lit(0)).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice("blocks", c * _CHUNK + 1, F.lit(_CHUNK)))
    start = F.struct(
        F.array().cast("array<bigint>").alias("free"),
        F.lit(0).cast("bigint").alias("end"),
        F.array().cast("array<array<bigint>>").alias("taken"),
    )
    slots = F.flatten(F.aggregate(chunks, start, take_chunk, lambda s: s["taken"])).alias("slot")
    taken = ordered.select("blocks", slots).select(F.explode(F.arrays_zip(F.col("blocks").alias("b"), F.col("slot").alias("slot"))).alias("t"))
    kept = ("key", "slots", "n", "weight", "j", "release", "deadline")
    return taken.select(*(F.col(f"t.b.{c}").alias(c) for c in kept), F.col("t.slot").alias("slot"))


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    weights: dict[str, float] | None = None,
    block_rows: int = BLOCK_ROWS,
    cycle: int = CYCLE,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """All rows of ``docs`` as the struct ``row``, with key, weight, slots, block, release, deadline, slot, place and in_mix.

    The mix is the order of (slot, place). No row is dropped or repeated: a source without blocks leaves its slots
    empty, and ``in_mix`` tells whether all sources still had blocks at this slot, so that the shares hold up to it. Rows of
    a source are ordered by md5 of the id, then the id; rows of one id in any order. Null ids are dealt out by
    their place in the input. A null source is a source of its own. Columns may have any names.

    A source is numbered in buckets of about ``bucket_rows`` rows, each with its offset, so a source that holds most rows
    is spread over as many tasks as it has buckets.
    """
    luck = F.md5(F.coalesce(F.col(id_column).cast("string"), F.concat(F.lit("null "), F.monotonically_increasing_id().cast("string"))).cast("binary"))
    rows = docs.select(F.struct("*").alias("row"), _key(source_column).alias("key"), luck.alias("luck"), F.col(id_column).alias("id"))
    sizes = docs.select(_key(source_column).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    planned = schedule(target_weights(sizes, weights, cycle))
    folder = scratch_path(docs.sparkSession, "schedule")
    planned.write.parquet(folder)
    slots = docs.sparkSession.read.schema(planned.schema).parquet(folder)  # one row per slot of a cycle
    if slots.count() <= BROADCAST_SLOTS:
        slots = F.broadcast(slots)
    per_source = slots.where("j = 0").select("key", "n", "weight", "slots")

    part = F.conv(F.substring("luck", 1, 12), 16, 10).cast("bigint") / float(1 << 48)
    placed = rows.join(per_source, "key").withColumn("bucket", F.floor(part * F.ceil(F.col("n") / bucket_rows)))
    buckets = (
        docs.select(_key(source_column).alias("key"), luck.alias("luck")).join(per_source, "key")
        .groupBy("key", F.floor(part * F.ceil(F.col("n") / bucket_rows)).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    )
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("key", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("key", "bucket").orderBy("luck", "id")
    numbered = placed.withColumn("nth", F.row_number().over(within)).join(offsets, ["key", "bucket"])
    number = F.col("offset") + F.col("nth") - 1
    numbered = numbered.select(
        "row", "key", "n", "weight", F.floor(number / block_rows).alias("block"), F.pmod(number, F.lit(block_rows)).alias("place")
    ).withColumn("j", F.pmod(F.col("block"), F.col("weight")))

    missing = F.ceil(F.col("n") / block_rows)  # a source's first block that does not exist
    ends = slots.where(F.col("j") == F.pmod(missing, F.col("weight")))
    horizon = ends.agg(F.min(F.floor(missing / F.col("weight")) * F.col("slots") + F.col("slot")).alias("horizon"))
    timed = numbered.join(slots.select("key", "j", "slots", "release", "deadline", "slot"), ["key", "j"])
    start = F.floor(F.col("block") / F.col("weight")) * F.col("slots")
    timed = timed.select(
        "row", "key", "weight", "slots", "block", *((start + F.col(c)).alias(c) for c in ("release", "deadline", "slot")), "place"
    )
    # the horizon is one number
    return timed.withColumn("in_mix", F.col("slot") < F.lit(horizon.collect()[0].horizon))


def in_mixed_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` sorted into the order of the mix (see ``mix``)."""
    return mix(docs, **options).orderBy("slot", "place").select("row.*")


def plan(docs: DataFrame, **options) -> DataFrame:
    """For each row of (doc_id, source): weight out of slots, block, release, deadline, slot, place in the block, in_mix."""
    rows = mix(docs, **options)
    return rows.select("row.*", "weight", "slots", "block", "release", "deadline", "slot", F.col("place").cast("bigint").alias("place"), "in_mix")


# The same in SQL: the schedule is walked slot by slot, rows are numbered by a plain window.
ORACLE_SQL = f"""
WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
weights AS (
  SELECT source, n, greatest(1, round(sqrt(n) / ceil(sum(sqrt(n)) OVER () / {MAX_SLOTS})))::BIGINT AS weight FROM sizes
),
lists AS (
  SELECT list(source ORDER BY source NULLS FIRST) AS names, list(weight ORDER BY source NULLS FIRST) AS ws, sum(weight)::BIGINT AS slots FROM weights
),
walk AS (
  SELECT 0::BIGINT AS t, list_transform(ws, lambda w: 0::BIGINT) AS upcoming, NULL::BIGINT AS took, NULL::BIGINT AS j FROM lists
  UNION ALL
  SELECT t + 1, list_transform(range(1, len(ws) + 1), lambda i: upcoming[i] + CASE WHEN i = best THEN 1 ELSE 0 END), best, upcoming[best]
  FROM (
    SELECT t, upcoming, ws, slots, list_min(list_transform(range(1, len(ws) + 1), lambda i:
      CASE WHEN floor(upcoming[i] * slots / ws[i]) <= t THEN ceil((upcoming[i] + 1) * slots / ws[i])::BIGINT * 16777216 + i END)) % 16777216 AS best
    FROM walk, lists WHERE t < slots
  )
),
picks AS (
  SELECT names[took] AS source, ws[took] AS weight, slots, j, t - 1 AS slot,
    floor(j * slots / ws[took])::BIGINT AS release, ceil((j + 1) * slots / ws[took])::BIGINT AS deadline
  FROM walk, lists WHERE t > 0
),
horizon AS (
  SELECT min(floor(ceil(n / {BLOCK_ROWS}) / p.weight)::BIGINT * slots + slot) AS h
  FROM picks p JOIN sizes s ON s.source IS NOT DISTINCT FROM p.source WHERE j = ceil(n / {BLOCK_ROWS})::BIGINT % p.weight
),
numbered AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS number FROM documents
),
blocks AS (SELECT doc_id, source, number // {BLOCK_ROWS} AS block, number % {BLOCK_ROWS} AS place FROM numbered)
SELECT b.doc_id, b.source, w.weight, slots, block, block // w.weight * slots + release AS release,
  block // w.weight * slots + deadline AS deadline, block // w.weight * slots + slot AS slot, place,
  block // w.weight * slots + slot < h AS in_mix
FROM blocks b JOIN weights w ON w.source IS NOT DISTINCT FROM b.source
JOIN picks p ON p.source IS NOT DISTINCT FROM b.source AND p.j = block % w.weight, horizon
"""
