"""Train / test split by a hash of the key, so that it does not depend on partitioning or on retries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.columns import column

BUCKETS = 100


def hash_bucket(keys: Sequence[str], seed: int = 42) -> Column:
    """A bucket in 0..99 from the seed and the key columns. A null key counts as empty text."""
    parts = [F.coalesce(column(k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % BUCKETS


def hash_split(
    df: DataFrame, keys: Sequence[str], test_size: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``; rows with equal keys stay together. ``test_size`` counts in hundredths."""
    held_out = round(test_size * BUCKETS)
    if not 0 < held_out < BUCKETS:
        raise ValueError(f"test_size must be between 0.01 and 0.99, not {test_size}")
    train = hash_bucket(keys, seed) < BUCKETS - held_out
    return df.filter(train), df.filter(~train)
