"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def pmi(n_docs: Column, n_both: Column | str, n_a: Column | str, n_b: Column | str) -> Column:
    """Pointwise mutual information, natural log.

    One quotient under one logarithm: equal ratios give bit-equal values, so
    ranking by the result breaks ties by the following sort columns only.
    """
    both, a, b = (F.col(c) if isinstance(c, str) else c for c in (n_both, n_a, n_b))
    return F.ln((n_docs.cast("double") * both) / (a.cast("double") * b))


def block_of(column: str, span: int) -> Column:
    """Number of the run of ``span`` whole numbers a value falls in, without rounding."""
    return F.expr(f"({column} - pmod({column}, {span}L)) div {span}L")


# Logs are summed in steps of this size; exponentials within a step stay far from overflow.
LOG_STEP = 256


def log_sum_exp(df: DataFrame, keys: list[str], log: str, name: str) -> DataFrame:
    """(keys…, name): the natural log of the sum of ``exp(log)`` over each key's rows.

    Logs of any size count, also where their exponential is no double. Each is scaled by
    the step it falls in, so the sums of a step are plain sums that merge map-side; a key
    has few steps, and those far below its highest one vanish beside it. A null log, or one
    of minus infinity (a zero), adds nothing; a key with nothing else has no row.
    """
    step = F.floor(F.col(log) / LOG_STEP)
    scaled = F.exp(F.col(log) - step * F.lit(float(LOG_STEP)))
    sums = (df.where(F.col(log).isNotNull() & (F.col(log) > F.lit(float("-inf"))))
            .groupBy(*keys, step.alias("step_")).agg(F.sum(scaled).alias("sum_")))
    per_key = sums.groupBy(*keys).agg(F.max("step_").alias("top_"),
                                      F.collect_list(F.struct("step_", "sum_")).alias("parts_"))
    total = F.aggregate("parts_", F.lit(0.0), lambda acc, p: acc + p["sum_"] * F.exp(
        (p["step_"] - F.col("top_")) * F.lit(float(LOG_STEP))))
    return per_key.select(*keys, (F.col("top_") * F.lit(float(LOG_STEP)) + F.ln(total)).alias(name))
