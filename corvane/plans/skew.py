"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

# A key is split once it has more rows than one task should take. The limit
# also never falls below total / MAX_HOT, so at most MAX_HOT keys can exceed it:
# the broadcast list of hot keys has a size bound that holds for any data.
TASK_ROWS = 1_000_000
MAX_HOT = 100_000


def hot_keys(weights: DataFrame, key: list[str], weight: str = "n",
             task_rows: int = TASK_ROWS) -> DataFrame | None:
    """Keys to split and into how many parts, or None when no key is too heavy.

    ``weights`` has one row per key. It is read twice, so pass a stored table or
    a cheap plan. Returns ``(key…, parts)`` with at most MAX_HOT rows.
    """
    total, top = weights.agg(F.sum(weight), F.max(weight)).first()
    if total is None:
        return None
    limit = max(task_rows, math.ceil(total / MAX_HOT))
    if top <= limit:
        return None
    parts = F.ceil(F.col(weight) / F.lit(limit)).cast("int")
    return weights.where(F.col(weight) > limit).select(*key, parts.alias("parts"))


def spread_rows(df: DataFrame, key: list[str], by: list[str], hot: DataFrame) -> DataFrame:
    """Add ``salt``: rows of a hot key are dealt out over its parts by a hash of ``by``."""
    dealt = F.pmod(F.xxhash64(*by), F.col("parts")).cast("int")
    return (df.join(F.broadcast(hot), key, "left")
            .withColumn("salt", F.coalesce(dealt, F.lit(0)))
            .drop("parts"))


def copy_rows(df: DataFrame, key: list[str], hot: DataFrame) -> DataFrame:
    """Add ``salt``: rows of a hot key are repeated once for each of its parts."""
    last = F.coalesce(F.col("parts") - 1, F.lit(0))
    return (df.join(F.broadcast(hot), key, "left")
            .withColumn("salt", F.explode(F.sequence(F.lit(0), last)))
            .drop("parts"))


def skew_join(big: DataFrame, small: DataFrame, key: list[str], weights: DataFrame, *,
              weight: str = "n", by: list[str], how: str = "inner",
              task_rows: int = TASK_ROWS) -> DataFrame:
    """``big`` joined to ``small`` on ``key``, with the hot keys of ``big`` split.

    ``weights`` gives the rows per key in ``big``, or a bound on them. Without a hot key this is the
    plain join, left to Catalyst and AQE. ``how`` is any type that keeps the left
    rows apart: inner, left, left_semi, left_anti.
    """
    hot = hot_keys(weights, key, weight, task_rows)
    if hot is None:
        return big.join(small, key, how)
    left = spread_rows(big, key, by, hot)
    right = copy_rows(small, key, hot)
    return left.join(right, [*key, "salt"], how).drop("salt")
