"""Mode, median, maximum and multiplicities of observations per key.

``obs`` is ``(k STRING, v INT)``; the ``real`` medians and the maximum take any numeric ``v``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corvane.plans.scratch import materialize
from corvane.plans.skew import TASK_ROWS, skew_join

# Values are grouped by their upper half: a key has at most 65536 ranges and a
# range at most 65536 values, so no window sees more rows than that for 32-bit
# values, however many observations a key has.
RANGE_BITS = 16
# The middle of a key's values is bracketed to within a share of 2 / ACCURACY of its rows.
ACCURACY = 1_000


def value_multiplicity(obs: DataFrame) -> DataFrame:
    """(k, v, n): how often each value occurs under a key."""
    return obs.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))


def group_mode(obs: DataFrame) -> DataFrame:
    """(k, mode): most frequent value, ties to the smallest.

    A maximum over (n, -v) aggregates map-side, so a hot key never moves as a group.
    """
    best = F.max(F.struct(F.col("n"), (-F.col("v").cast("bigint")).alias("neg")))
    return (value_multiplicity(obs).groupBy("k").agg(best.alias("best"))
            .select("k", (-F.col("best.neg")).alias("mode")))


def group_max(obs: DataFrame) -> DataFrame:
    """(k, max): largest value per key."""
    return obs.groupBy("k").agg(F.max("v").alias("max"))


def _at_middle(counts: DataFrame, carried: Column, prev: Column) -> DataFrame:
    """The row of the middle value among the sorted values of each (k, part)."""
    in_part = Window.partitionBy("k", "part").orderBy("v")
    return (counts.withColumn("upto", carried + F.sum("n").over(in_part))
            .withColumn("prev", F.coalesce(F.lag("v").over(in_part), prev))
            .where((F.col("upto") >= F.col("mid")) & (F.col("upto") - F.col("n") < F.col("mid")))
            .select("k", "total", "mid", "prev", F.col("v").alias("cur"), "upto", "n"))


def _middle(obs: DataFrame) -> DataFrame:
    """(k, total, mid, prev, cur, upto, n) of the value at rank total div 2 + 1.

    ``cur`` is that value, ``n`` its count, ``upto`` the observations up to and
    including it, and ``prev`` the next smaller distinct value of the key.
    """
    counts = value_multiplicity(obs).withColumn("v", F.col("v").cast("bigint"))
    mid = F.expr("total div 2 + 1")
    # Ranges of values first: find the one that holds the middle of each key ...
    counts = counts.withColumn("part", F.shiftright("v", RANGE_BITS))
    in_key = Window.partitionBy("k").orderBy("part")
    ranges = (counts.groupBy("k", "part").agg(F.sum("n").alias("in_part"), F.max("v").alias("top"))
              .withColumn("below", F.sum("in_part").over(in_key) - F.col("in_part"))
              .withColumn("prev_top", F.lag("top").over(in_key))
              .withColumn("total", F.sum("in_part").over(Window.partitionBy("k")))
              .withColumn("mid", mid)
              .where((F.col("below") < F.col("mid"))
                     & (F.col("below") + F.col("in_part") >= F.col("mid")))
              .select("k", "part", "below", "prev_top", "total", "mid"))
    # ... then the value inside that range.
    return _at_middle(counts.join(ranges, ["k", "part"]), F.col("below"), F.col("prev_top"))


def group_median(obs: DataFrame) -> DataFrame:
    """(k, median): the median, truncated toward zero to a whole number."""
    low = F.expr("CASE WHEN total % 2 = 0 AND upto - n = mid - 1 THEN prev ELSE cur END")
    return (_middle(obs).withColumn("low", low)
            .select("k", F.expr("(low + cur) div 2").alias("median")))


def group_median_compat(obs: DataFrame) -> DataFrame:
    """(k, median) by the original even-count rule.

    It averages with the previous value whenever the middle rank lies at or past
    half of the current value's run, which differs from the true median on ties.
    """
    rule = F.expr("""CASE WHEN total % 2 = 1 OR prev IS NULL OR 2 * upto < 2 * mid + n THEN cur
                          ELSE (prev + cur) div 2 END""")
    return _middle(obs).select("k", rule.alias("median"))


def _brackets(obs: DataFrame, accuracy: int) -> DataFrame:
    """(k, total, mid, low, high): values between which ranks mid - 1 and mid of a key lie.

    Quantile summaries are merged map-side; their rank error is at most total / accuracy,
    so quantiles that far apart from the middle hold it between them.
    """
    slack = 2.0 / accuracy
    quantiles = F.percentile_approx("v", [0.0, 0.5 - slack, 0.5 + slack, 1.0], accuracy)
    found = obs.groupBy("k").agg(F.count(F.lit(1)).alias("total"), quantiles.alias("q"))
    # Few rows: the slack may be less than the one rank between the two middle values.
    wide = F.col("total") * F.lit(slack) < 4
    return found.select("k", "total", F.expr("total div 2 + 1").alias("mid"),
                        F.when(wide, F.col("q")[0]).otherwise(F.col("q")[1]).alias("low"),
                        F.when(wide, F.col("q")[3]).otherwise(F.col("q")[2]).alias("high"))


def _middle_real(obs: DataFrame, accuracy: int, task_rows: int) -> DataFrame:
    """(k, total, mid, prev, cur, upto, n) as in :func:`_middle`, for values of any type.

    Two passes: quantile summaries bracket the middle, then the values inside the bracket
    are sorted, a small share of a large key's, while those below are only counted.
    """
    brackets = materialize(_brackets(obs, accuracy), "brackets")
    placed = skew_join(obs, brackets.select("k", "low", "high"), ["k"], brackets, weight="total", by=["v"],
                       task_rows=task_rows).where(F.col("v") <= F.col("high"))
    below = F.col("v") < F.col("low")
    # Values below the bracket count as one row for each key, at the greatest of them.
    counts = (placed.groupBy("k", F.when(~below, F.col("v")).alias("inside"))
              .agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("v")))
    in_key = Window.partitionBy("k").orderBy("v")
    return (counts.withColumn("upto", F.sum("n").over(in_key)).withColumn("prev", F.lag("v").over(in_key))
            .join(brackets.select("k", "total", "mid"), "k")
            .where((F.col("upto") >= F.col("mid")) & (F.col("upto") - F.col("n") < F.col("mid")))
            .select("k", "total", "mid", "prev", F.col("v").alias("cur"), "upto", "n"))


def _reals(obs: DataFrame) -> DataFrame:
    return obs.where("v IS NOT NULL").select("k", F.col("v").cast("double").alias("v"))


def group_median_real(obs: DataFrame, accuracy: int = ACCURACY, *, task_rows: int = TASK_ROWS) -> DataFrame:
    """(k, median DOUBLE): the median of values of any numeric type, the mean of the two
    middle ones of an even number. Null values don't count; NaN is the greatest value."""
    low = F.expr("CASE WHEN total % 2 = 0 AND upto - n = mid - 1 THEN prev ELSE cur END")
    return (_middle_real(_reals(obs), accuracy, task_rows).withColumn("low", low)
            .select("k", ((F.col("low") + F.col("cur")) / 2).alias("median")))


def group_median_real_compat(obs: DataFrame, accuracy: int = ACCURACY, *, task_rows: int = TASK_ROWS) -> DataFrame:
    """(k, median DOUBLE) by the original even-count rule (:func:`group_median_compat`)."""
    rule = F.expr("""CASE WHEN total % 2 = 1 OR prev IS NULL OR 2 * upto < 2 * mid + n THEN cur
                          ELSE (prev + cur) / 2 END""")
    return _middle_real(_reals(obs), accuracy, task_rows).select("k", rule.alias("median"))
