"""Counts and checks over a directed graph.

``nodes`` is ``(id BIGINT)``; ``edges`` is ``(src BIGINT, dst BIGINT)``, repeated
edges kept. Every src is a node; a dst may be unknown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corvane.plans.skew import TASK_ROWS, skew_join


def _per_id(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, known, outs, ins) of every id seen, by one aggregate over a union."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    rows = (nodes.select("id", one.alias("known"), none.alias("outs"), none.alias("ins"))
            .unionByName(edges.select(F.col("src").alias("id"), none.alias("known"),
                                      one.alias("outs"), none.alias("ins")))
            .unionByName(edges.select(F.col("dst").alias("id"), none.alias("known"),
                                      none.alias("outs"), one.alias("ins"))))
    return rows.groupBy("id").agg(F.sum("known").alias("known"), F.sum("outs").alias("outs"),
                                  F.sum("ins").alias("ins"))


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: num_nodes, num_edges, num_active_nodes, num_dangling, num_missing_targets."""
    known = F.col("known") > 0
    return _per_id(nodes, edges).agg(
        F.count_if(known).alias("num_nodes"),
        F.coalesce(F.sum("outs"), F.lit(0)).alias("num_edges"),
        F.count_if(known & (F.col("outs") > 0)).alias("num_active_nodes"),
        F.count_if(known & (F.col("outs") == 0)).alias("num_dangling"),
        F.count_if(~known & (F.col("ins") > 0)).alias("num_missing_targets"))


def message_stats(nodes: DataFrame, edges: DataFrame, *, task_rows: int = TASK_ROWS) -> DataFrame:
    """One row: messages_sent and distinct_targets of one propagation step.

    Only listed nodes send; a target need not be listed.
    """
    fan_out = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    sent = skew_join(edges, nodes.select(F.col("id").alias("src")), ["src"], fan_out, by=["dst"],
                     how="left_semi", task_rows=task_rows)
    per_target = sent.groupBy("dst").agg(F.count(F.lit(1)).alias("n"))
    return per_target.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("messages_sent"),
                          F.count(F.lit(1)).alias("distinct_targets"))


def edge_touched_nodes(edges: DataFrame) -> DataFrame:
    """(id): the vertices some edge touches."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def repeated_nodes(nodes: DataFrame) -> DataFrame:
    """(id, listed): the node ids that are listed more than once, and how often."""
    return nodes.groupBy("id").agg(F.count(F.lit(1)).alias("listed")).where("listed > 1")


def check_graph(nodes: DataFrame, edges: DataFrame) -> None:
    """Raise ValueError for a node listed twice or an edge from an unknown node."""
    bad = (_per_id(nodes, edges)
           .where((F.col("known") > 1) | ((F.col("known") == 0) & (F.col("outs") > 0)))
           .limit(1).collect())
    if bad and bad[0].known > 1:
        raise ValueError(f"node {bad[0].id} is listed {bad[0].known} times")
    if bad:
        raise ValueError(f"edges leave node {bad[0].id}, which is not listed")
