"""Connected components, and components of what shares buckets without comparing all with all."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table to the shared folder and read it again: what follows does not depend on executors that were lost.

    Shuffle files of the job go when it ends, as nothing reads them again; else they stay until the driver collects its garbage.
    """
    conf, before = df.sparkSession.conf, df.sparkSession.conf.get(SHUFFLES_GO, "false")
    conf.set(SHUFFLES_GO, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(SHUFFLES_GO, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, root) for all nodes of ``edges`` (a, b) but the roots, by alternating large and small stars.

    The root is the least node of a component.

    Every step keeps at most as many edges as there were. Steps go on until the edges no longer change, which takes
    about the logarithm of the longest path. A node with many edges is no group: its least neighbour is an aggregate
    that is built before the shuffle.
    """
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    step = 0
    current = stored(current, f"{folder}/stars-0")
    before = _content(current)
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        step += 1
        current = stored(small.union(down.select("a", F.col("m").alias("b"))).distinct(), f"{folder}/stars-{step}")
        now = _content(current)
        if now == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def _content(edges: DataFrame):
    """Numbers that are the same for equal edges."""
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40)), F.sum(F.hash("b", "a"))).collect()[0]


#: Rows of a part of a bucket that is compared in tasks, and pairs of a task on average.
PART, PAIRS_PER_TASK = 1000, 1 << 24


@dataclass(frozen=True)
class InTasks:
    """Whether two members can be linked, as a column, and for all pairs of a bucket as a function of its rows.

    ``pairs`` gets rows that are dealt out and sorted by ``CELL``, with the columns ``part``, member, root and those about it. Of each cell it returns
    (a, b) of the pairs of different roots that can be linked: all if ``low`` is ``high``, else those of different parts.
    """

    column: Callable[[Callable[[str], Column], Callable[[str], Column]], Column]
    pairs: Callable[[DataFrame], DataFrame]

    def __call__(self, a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
        return self.column(a, b)


CELL = ["bucket", "low", "high"]


def in_cells(rows: DataFrame, pairs: int) -> DataFrame:
    """Rows (bucket, member, of that many in the bucket ``n``, ...) dealt out so that any two of a bucket meet in one cell of at most about two parts."""
    parts = F.ceil(F.col("n") / PART).cast("int")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("member"), parts).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))).drop("n")
    rows = rows.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other")).drop("other")
    # a number that is given holds: by the bytes of the rows alone, few tasks would have many pairs
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs // PAIRS_PER_TASK))
    return rows.repartition(tasks, *CELL).sortWithinPartitions(*CELL)


def linked(
    marks: DataFrame,
    about: list[str],
    like: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
    verify: Callable[[DataFrame], DataFrame],
    folder: str,
    facts: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Links and components of members (bucket, member, and the columns ``about``) that share a bucket.

    The columns ``about`` may come from ``facts`` (member, ``about``) instead, one row for each member; they are then shuffled less.

    ``like`` tells from the columns of two members whether they can be linked, ``verify`` takes pairs (a, b) and
    returns those that are, with other columns or not. Returns links that span each component, and (node, root).

    First each member is compared with the one of its bucket that has most company over all its buckets, as an
    original has among its copies. Members of one component need no comparison any more, so a group of near
    copies is settled by as many pairs as it has members. Then all pairs of different components are compared that ``like``
    lets through; it is part of the join, so it should be a bound that few others pass. As ``InTasks`` it compares the rows of buckets
    without a join, and a large bucket in cells, so that its pairs are spread over tasks.
    """
    company = marks.groupBy("bucket").agg(F.count(F.lit(1)).alias("company")).where("company > 1")
    ranks = marks.join(company, "bucket").groupBy("member").agg(F.sum("company").alias("rank"))
    marks = marks.join(company.select("bucket"), "bucket", "left_semi").join(ranks, "member")
    marks = stored(marks if facts is None else marks.join(facts, "member"), f"{folder}/marks-0")

    def distinct_pairs(pairs: DataFrame, a: Callable[[str], Column], b: Callable[[str], Column]) -> DataFrame:
        least, greatest = F.least(a("member"), b("member")), F.greatest(a("member"), b("member"))
        return pairs.where(like(a, b)).select(least.alias("a"), greatest.alias("b")).distinct()

    def with_leader(rows: DataFrame) -> DataFrame:
        leaders = rows.groupBy("bucket").agg(F.max(F.struct("rank", "member", "root", *about)).alias("leader"))
        pairs = rows.join(leaders, "bucket").where("root <> leader.root")
        return distinct_pairs(pairs, F.col, lambda c: F.col(f"leader.{c}"))

    def all_pairs(rows: DataFrame) -> DataFrame:
        left = rows.select("bucket", F.struct("member", "root", *about).alias("left"))
        pairs = left.join(rows, "bucket").where("left.member < member and left.root <> root")
        return distinct_pairs(pairs, F.col, lambda c: F.col(f"left.{c}"))

    links = stored(verify(with_leader(marks.withColumn("root", F.col("member")))), f"{folder}/links-0")
    roots = components(links.select("a", "b"), f"{folder}/roots-0")
    rows = marks.join(roots.withColumnRenamed("node", "member"), "member", "left").withColumn("root", F.coalesce("root", "member"))
    mixed = rows.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")).where("low <> high")
    if isinstance(like, InTasks):
        rest = stored(rows.drop("rank").join(mixed.select("bucket", "n"), "bucket"), f"{folder}/rest")
        pairs = rest.agg(F.sum(F.col("n") - 1)).first()[0] or 0
        found = like.pairs(in_cells(rest, pairs // 2)).distinct()
    else:
        rest = stored(rows.join(mixed.select("bucket"), "bucket", "left_semi"), f"{folder}/rest")
        found = all_pairs(rest)
    more = stored(verify(found), f"{folder}/links-1")
    if more.isEmpty():
        return links, roots
    # the components so far are stars, which new links only have to join
    known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return links.union(more), components(known.union(more.select("a", "b")), f"{folder}/roots-1")


def every_link(marks: DataFrame, about: list[str], like: Callable[[Callable[[str], Column], Callable[[str], Column]], Column], verify) -> DataFrame:
    """All links of members that share a bucket, also within components (arguments as in ``linked``, whose links only span each of them).

    Its work grows with the square of a group of members that are near to each other, as the number of their links does.
    """
    left = marks.select("bucket", F.struct("member", *about).alias("left"))
    pairs = left.join(marks, "bucket").where("left.member < member").where(like(lambda c: F.col(f"left.{c}"), F.col))
    return verify(pairs.select(F.col("left.member").alias("a"), F.col("member").alias("b")).distinct())
