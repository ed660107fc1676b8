"""Ranked listings of node scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def top_n_per_source(ranks: DataFrame, n: int = 10) -> DataFrame:
    """(source, rank, id, score): the n best nodes of each source, ties to the least id."""
    best = Window.partitionBy("source").orderBy(F.desc("score"), "id")
    return (ranks.withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= n)
            .select("source", "rank", "id", "score"))


def rank_all(scores: DataFrame) -> DataFrame:
    """(id, score): every node, best first, ties in id order."""
    return scores.select("id", "score").orderBy(F.desc("score"), "id")


def top_report(top: DataFrame) -> DataFrame:
    """(source, rank, line): printable lines, a ``Source:`` header as rank 0."""
    rows = top.select("source", "rank", F.format_string("%.5f %d", "score", "id").alias("line"))
    heads = top.select("source").distinct().select(
        "source", F.lit(0).alias("rank"),
        F.concat(F.lit("Source: "), F.col("source").cast("string")).alias("line"))
    return heads.unionByName(rows).orderBy("source", "rank")
