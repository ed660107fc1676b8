"""Weakly connected components by alternating large-star and small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014): links
are rewired toward the least known neighbour until every component is a star
around its least id. Rounds grow with the logarithm of the component size, not
with its diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corvane.plans.scratch import materialize
from corvane.plans.skew import TASK_ROWS, skew_join

# A link is (hi, lo) with hi > lo.


def _large_star(links: DataFrame, task_rows: int) -> DataFrame:
    """Attach the larger neighbours of every node to its least neighbour."""
    ends = F.array(F.struct(F.col("lo").alias("node"), F.col("hi").alias("nbr")),
                   F.struct(F.col("hi").alias("node"), F.col("lo").alias("nbr")))
    least = (links.select(F.explode(ends).alias("e")).select("e.node", "e.nbr")
             .groupBy(F.col("node").alias("lo"))
             .agg(F.least(F.min("nbr"), F.col("lo")).alias("root"), F.count(F.lit(1)).alias("n")))
    least = materialize(least, "least")
    rewired = (skew_join(links, least.select("lo", "root"), ["lo"], least, by=["hi"],
                         task_rows=task_rows)
               .select("hi", F.col("root").alias("lo")).distinct())
    return materialize(rewired, "large", replaces=[links, least])


def _small_star(links: DataFrame, task_rows: int) -> DataFrame:
    """Attach every node and its smaller neighbours to the least of them."""
    least = materialize(links.groupBy("hi").agg(F.min("lo").alias("root"),
                                                F.count(F.lit(1)).alias("n")), "least")
    moved = (skew_join(links, least.select("hi", "root"), ["hi"], least, by=["lo"],
                       task_rows=task_rows)
             .where(F.col("lo") > F.col("root"))
             .select(F.col("lo").alias("hi"), F.col("root").alias("lo")))
    rewired = moved.unionByName(least.select("hi", F.col("root").alias("lo"))).distinct()
    return materialize(rewired, "small", replaces=[links, least])


def _is_star_forest(links: DataFrame) -> bool:
    """Every node hangs on one root and no root hangs on another."""
    ends = F.array(F.struct(F.col("hi").alias("node"), F.lit(1).alias("hangs")),
                   F.struct(F.col("lo").alias("node"), F.lit(0).alias("hangs")))
    per_node = (links.select(F.explode(ends).alias("e")).select("e.node", "e.hangs")
                .groupBy("node").agg(F.sum("hangs").alias("roots"), F.min("hangs").alias("leaf")))
    return per_node.where((F.col("roots") > 1)
                          | ((F.col("roots") == 1) & (F.col("leaf") == 0))).isEmpty()


def weakly_connected_components(nodes: DataFrame, edges: DataFrame, *,
                                task_rows: int = TASK_ROWS) -> DataFrame:
    """(id, component): component is the least id that is reachable ignoring direction.

    Ids that only edges name link their neighbours but get no row.
    """
    links = materialize(
        edges.where(F.col("src") != F.col("dst"))
        .select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo"))
        .distinct(), "links")
    done = False
    while not done:
        links = _large_star(links, task_rows)
        links = _small_star(links, task_rows)
        done = _is_star_forest(links)
    return (nodes.join(links.withColumnRenamed("hi", "id"), "id", "left")
            .select("id", F.coalesce("lo", "id").alias("component")))


def component_count(components: DataFrame) -> DataFrame:
    """(n): number of components."""
    return (components.select("component").distinct()
            .agg(F.count(F.lit(1)).alias("n")))
