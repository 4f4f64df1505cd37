"""Training and validation splits, and row samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1000


def random_split(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 17) -> list[DataFrame]:
    """Spark's own seeded split. Its rows depend on how the input is partitioned."""
    return df.randomSplit(list(weights), seed)


def hash_draw(df: DataFrame, key: str, offset: int = 7) -> Column:
    """A number in [0, 2**32) from the row key alone: a number is shifted by ``offset``, a text salted with it."""
    salted = F.col(key) + offset if isinstance(df.schema[key].dataType, T.NumericType) else F.concat(F.lit(f"{offset}:"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(salted.cast("string")), 1, 8), 16, 10).cast("bigint")


def hash_bucket(df: DataFrame, key: str, offset: int = 7) -> Column:
    """A number in 0..999 from the row key alone."""
    return hash_draw(df, key, offset) % BUCKETS


def in_training(df: DataFrame, key: str, train: float = 0.7, offset: int = 7) -> Column:
    """Whether a row belongs to the first part of :func:`hash_split`."""
    coarse = abs(train * BUCKETS - round(train * BUCKETS)) < 1e-9
    chosen = hash_bucket(df, key, offset) < round(train * BUCKETS) if coarse else hash_draw(df, key, offset) < round(train * 2**32)
    return F.coalesce(chosen, F.lit(False))


def hash_split(df: DataFrame, key: str, train: float = 0.7, offset: int = 7) -> tuple[DataFrame, DataFrame]:
    """A split that any rerun, on any partitioning, repeats row by row; rows without key go to the second part.

    Shares in thousandths go by bucket, finer ones by the whole range of the hash.
    """
    chosen = in_training(df, key, train, offset)
    return df.filter(chosen), df.filter(~chosen)


def mini_batch(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """A random part of the rows, without replacement."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    return df if fraction == 1 else df.sample(False, fraction, seed)
