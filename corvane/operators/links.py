"""Two-hop neighbourhoods and clustering coefficients of adjacency lists.

``edges`` is ``(src BIGINT, dst BIGINT)``: src's list names dst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corvane.functions.measures import block_of
from corvane.plans.scratch import materialize
from corvane.plans.skew import TASK_ROWS, skew_join

# Neighbour ids of one block span this many ids, which bounds the list in a row.
SPAN = 1_000_000
# Pairs one task may form from a common neighbour.
TASK_PAIRS = 100 * TASK_ROWS


def _merged(edges: DataFrame) -> DataFrame:
    """(src, dst, k): each listed neighbour once, with how often it is listed."""
    return materialize(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("k")), "lists")


def _list_sizes(merged: DataFrame) -> DataFrame:
    """(src, n, listed): distinct neighbours and list length of every list."""
    sizes = merged.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("listed"))
    return materialize(sizes, "sizes")


def _two_hop(merged: DataFrame, asked: DataFrame, task_pairs: int) -> DataFrame:
    """(node, nbr): the other members of the lists that name an asked node, each once.

    The work is the sizes of the lists that name asked nodes, so a hub's members are
    never paired with each other unless they are all asked for.
    """
    sizes = _list_sizes(merged)
    fan_in = merged.groupBy("dst").agg(F.count(F.lit(1)).alias("n"))
    named = skew_join(merged, asked.select(F.col("id").alias("dst")).distinct(), ["dst"], fan_in,
                      by=["src"], how="left_semi", task_rows=task_pairs)
    named = materialize(named.select("src", F.col("dst").alias("node"), F.col("k").alias("times")),
                        "named")
    asked_of = named.groupBy("src").agg(F.count(F.lit(1)).alias("asked"))
    weights = materialize(sizes.join(asked_of, "src")
                          .select("src", (F.col("n") * F.col("asked")).alias("n")), "weights")
    members = merged.select("src", F.col("dst").alias("nbr"))
    # A list that repeats a node makes it its own two-hop neighbour.
    return (skew_join(members, named, ["src"], weights, by=["nbr"], task_rows=task_pairs)
            .where((F.col("node") != F.col("nbr")) | (F.col("times") > 1))
            .select("node", "nbr").distinct())


def two_hop_pairs(edges: DataFrame, asked: DataFrame, exclude_direct: bool = False, *,
                  task_pairs: int = TASK_PAIRS) -> DataFrame:
    """(node, nbr): nodes that share a common neighbour with a node of ``asked`` (id),
    direct neighbours included unless ``exclude_direct``."""
    merged = _merged(edges)
    pairs = _two_hop(merged, asked, task_pairs)
    if exclude_direct:
        direct = merged.select(F.col("src").alias("node"), F.col("dst").alias("nbr"))
        pairs = pairs.join(direct, ["node", "nbr"], "left_anti")
    return pairs


def _blocks(pairs: DataFrame, span: int) -> DataFrame:
    block = F.coalesce(block_of("nbr", span), F.lit(0))
    return (pairs.groupBy("node", block.alias("block"))
            .agg(F.sort_array(F.collect_list("nbr")).alias("nbrs")))


def two_hop_neighbors(edges: DataFrame, asked: DataFrame, exclude_direct: bool = False,
                      span: int = SPAN, *, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """(node, block, nbrs): the two-hop neighbours of the asked nodes in blocks of ``span`` ids.

    An asked node with a list always has its block 0, empty if there is nothing in it.
    """
    listed = (edges.select(F.col("src").alias("node")).distinct()
              .join(asked.select(F.col("id").alias("node")), "node", "left_semi")
              .select("node", F.lit(None).cast("bigint").alias("nbr")))
    return _blocks(two_hop_pairs(edges, asked, exclude_direct, task_pairs=task_pairs)
                   .unionByName(listed), span)


def two_hop_neighbors_nonempty(edges: DataFrame, asked: DataFrame, span: int = SPAN, *,
                               task_pairs: int = TASK_PAIRS) -> DataFrame:
    """(node, block, nbrs) of the asked nodes with at least one two-hop neighbour."""
    return _blocks(two_hop_pairs(edges, asked, task_pairs=task_pairs), span)


def _triangles(merged: DataFrame, task_rows: int, task_pairs: int) -> DataFrame:
    """(u, v, w, uv, vu, uw, wu, vw, wv): every triangle once, with its directed edges.

    Edges point from the end of lower degree to the other, so no node has more
    than sqrt(2 * edges) of them and a hub's neighbours are never paired up.
    """
    up = F.col("src") < F.col("dst")
    sides = (merged.where(F.col("src") != F.col("dst"))
             .groupBy(F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y"))
             .agg(F.bool_or(up).alias("xy"), F.bool_or(~up).alias("yx")))
    sides = materialize(sides, "sides")
    degrees = materialize(sides.select(F.explode(F.array("x", "y")).alias("x"))
                          .groupBy("x").agg(F.count(F.lit(1)).alias("n")), "degrees")
    at_x = degrees.withColumnRenamed("n", "dx")
    at_y = degrees.select(F.col("x").alias("y"), F.col("n").alias("dy"))
    both = skew_join(skew_join(sides, at_x, ["x"], degrees, by=["y"], task_rows=task_rows),
                     at_y, ["y"], at_y, weight="dy", by=["x"], task_rows=task_rows)
    rises = F.struct("dx", "x") < F.struct("dy", "y")

    def pick(a: str, b: str) -> Column:
        return F.when(rises, F.col(a)).otherwise(F.col(b))

    rising = materialize(both.select(
        pick("x", "y").alias("lo"), pick("y", "x").alias("hi"),
        pick("xy", "yx").alias("up"), pick("yx", "xy").alias("down"),
        pick("dx", "dy").alias("dlo"), pick("dy", "dx").alias("dhi")), "rising")
    first = rising.select(F.col("lo").alias("u"), F.col("hi").alias("v"), F.col("dhi").alias("dv"),
                          F.col("up").alias("uv"), F.col("down").alias("vu"))
    second = rising.select(F.col("lo").alias("u"), F.col("hi").alias("w"), F.col("dhi").alias("dw"),
                           F.col("up").alias("uw"), F.col("down").alias("wu"))
    third = rising.select(F.col("lo").alias("v"), F.col("hi").alias("w"),
                          F.col("up").alias("vw"), F.col("down").alias("wv"), "dlo")
    # A node of out-degree d opens d * d ordered wedges.
    opened = materialize(rising.groupBy(F.col("lo").alias("u")).agg(
        (F.count(F.lit(1)) * F.count(F.lit(1))).alias("n")), "wedges")
    wedges = (skew_join(first, second, ["u"], opened, by=["v"], task_rows=task_pairs)
              .where(F.struct("dv", "v") < F.struct("dw", "w")).drop("dv", "dw"))
    # v and w close as many wedges as they share neighbours: at most v's degree.
    return skew_join(wedges, third.drop("dlo"), ["v", "w"], third, weight="dlo", by=["u"],
                     task_rows=task_pairs)


def _loop_closures(merged: DataFrame, sizes: DataFrame, task_rows: int) -> DataFrame:
    """(node, nbr) edges that are closed because a list names its own node."""
    loops = merged.where(F.col("src") == F.col("dst")).select("src")
    plain = merged.where(F.col("src") != F.col("dst")).select("src", "dst")
    near = skew_join(plain, loops, ["src"], sizes, by=["dst"], how="left_semi",
                     task_rows=task_rows).select(F.col("src").alias("node"), F.col("dst").alias("nbr"))
    back = near.join(plain.select(F.col("dst").alias("node"), F.col("src").alias("nbr")),
                     ["node", "nbr"], "left_semi").select(F.col("nbr").alias("node"),
                                                          F.col("node").alias("nbr"))
    twice = merged.where(F.col("k") > 1).select(F.col("dst").alias("src")).distinct()
    own = loops.join(twice, "src", "left_semi").select(F.col("src").alias("node"),
                                                       F.col("src").alias("nbr"))
    return near.unionByName(back).unionByName(own)


def clustering_compat(edges: DataFrame, *, task_rows: int = TASK_ROWS,
                      task_pairs: int = TASK_PAIRS) -> DataFrame:
    """(node, closed, possible) by the original rule.

    ``closed`` is half the number of direct neighbours that are two-hop neighbours
    as well, ``possible`` is k(k+1)/2 for k direct neighbours, both whole numbers.
    """
    merged = _merged(edges)
    sizes = _list_sizes(merged)
    # p's list names q, and a third list names both.
    closed = [("u", "v", "uv", "wu", "wv"), ("v", "u", "vu", "wu", "wv"),
              ("u", "w", "uw", "vu", "vw"), ("w", "u", "wu", "vu", "vw"),
              ("v", "w", "vw", "uv", "uw"), ("w", "v", "wv", "uv", "uw")]
    turns = F.array(*[F.struct(F.col(p).alias("node"), F.col(q).alias("nbr"),
                               (F.col(e) & F.col(f) & F.col(g)).alias("held"))
                      for p, q, e, f, g in closed])
    pairs = (_triangles(merged, task_rows, task_pairs).select(F.explode(turns).alias("t"))
             .where(F.col("t.held")).select("t.node", "t.nbr"))
    if not merged.where(F.col("src") == F.col("dst")).isEmpty():
        pairs = pairs.unionByName(_loop_closures(merged, sizes, task_rows))
    halves = pairs.distinct().groupBy("node").agg(F.count(F.lit(1)).alias("both"))
    # Nodes that only appear in others' lists are two-hop neighbours with no list.
    reached = skew_join(merged, sizes.where(F.col("listed") > 1).select("src"), ["src"], sizes,
                        by=["dst"], how="left_semi", task_rows=task_rows)
    rows = (sizes.select(F.col("src").alias("node"), "n")
            .unionByName(reached.select(F.col("dst").alias("node"), F.lit(0).cast("bigint").alias("n"))))
    return (rows.groupBy("node").agg(F.max("n").alias("k"))
            .join(halves, "node", "left")
            .select("node", F.expr("coalesce(both, 0) div 2").alias("closed"),
                    F.expr("k * (k + 1) div 2").alias("possible")))


def clustering_coefficient(edges: DataFrame, *, task_rows: int = TASK_ROWS,
                           task_pairs: int = TASK_PAIRS) -> DataFrame:
    """(node, links, possible, lcc): the standard local clustering coefficient.

    Directions are ignored; lcc is NULL for a node with fewer than two neighbours.
    """
    merged = _merged(edges)
    links = (_triangles(merged, task_rows, task_pairs)
             .select(F.explode(F.array("u", "v", "w")).alias("node"))
             .groupBy("node").agg(F.count(F.lit(1)).alias("links")))
    ends = merged.where(F.col("src") != F.col("dst")).select(
        F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y")).distinct()
    degrees = (ends.select(F.explode(F.array("x", "y")).alias("node"))
               .groupBy("node").agg(F.count(F.lit(1)).alias("k")))
    return (degrees.join(links, "node", "left")
            .select("node", F.coalesce("links", F.lit(0)).alias("links"),
                    F.expr("k * (k - 1) div 2").alias("possible"))
            .withColumn("lcc", F.expr("try_divide(cast(links AS double), possible)")))
