"""Personalized and global PageRank with a fixed number of iterations.

Per source ``s``, with ``m(v)`` the score that arrives along edges and
``missing = 1 - sum of m over the nodes``:

    r'(v) = alpha * [v = s] + (1 - alpha) * (m(v) + missing * [v = s])

All scores sum to 1, so every node can return its share of the jump and of the
missing score itself: what it does not send along known edges goes to the source.
An iteration is then one join and one sum, with no total to wait for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corvane.functions.measures import block_of, log_sum_exp
from corvane.operators.graphstats import check_graph
from corvane.plans.loop import check_state, iterate, last_state
from corvane.plans.scratch import materialize, release
from corvane.plans.skew import TASK_ROWS, copy_rows, hot_keys, skew_join, spread_rows

ALPHA = 0.15


def _require_sources(nodes: DataFrame, sources: list[int]) -> list[int]:
    wanted = list(dict.fromkeys(sources))
    found = {r.id for r in nodes.where(F.col("id").isin(wanted)).select("id").distinct().collect()}
    lacking = [s for s in wanted if s not in found]
    if not wanted or lacking:
        raise ValueError(f"sources not in the graph: {lacking}" if lacking else "no sources")
    return wanted


def build_rank_records(nodes: DataFrame, sources: list[int]) -> DataFrame:
    """(id, source, score): the initial state, all score of a source on itself."""
    wanted = _require_sources(nodes, sources)
    each = F.explode(F.array(*[F.lit(s).cast("bigint") for s in wanted]))
    return (nodes.select("id", each.alias("source"))
            .withColumn("score", (F.col("id") == F.col("source")).cast("double")))


def _transition(nodes: DataFrame, edges: DataFrame, alpha: float,
                task_rows: int) -> tuple[DataFrame, DataFrame]:
    """(src, dst, w) and (src, n): shares of a node's score and how many it has at most.

    A share with dst NULL is what returns to the source.
    """
    merged = materialize(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("k")), "edges")
    check_graph(nodes, merged)
    fan_in = materialize(merged.groupBy("dst").agg(F.count(F.lit(1)).alias("n")), "fan-in")
    known = nodes.select(F.col("id").alias("dst"), F.lit(True).alias("known"))
    flagged = materialize(
        skew_join(merged, known, ["dst"], fan_in, by=["src"], how="left", task_rows=task_rows)
        .withColumn("known", F.coalesce("known", F.lit(False))), "flagged", replaces=[merged, fan_in])
    kept = F.when(F.col("known"), F.col("k")).otherwise(0)
    fan_out = materialize(
        flagged.groupBy("src").agg(F.sum("k").alias("outs"), F.sum(kept).alias("kept"),
                                   F.count(F.lit(1)).alias("n")), "fan-out")
    sent = (skew_join(flagged.where("known").drop("known"), fan_out.select("src", "outs"), ["src"],
                      fan_out, by=["dst"], task_rows=task_rows)
            .select("src", "dst", (F.lit(1.0 - alpha) * F.col("k") / F.col("outs")).alias("w")))
    share = F.coalesce(F.col("kept") / F.col("outs"), F.lit(0.0))
    returned = (nodes.select(F.col("id").alias("src")).join(fan_out, "src", "left")
                .select("src", F.lit(None).cast("bigint").alias("dst"),
                        (F.lit(1.0) - F.lit(1.0 - alpha) * share).alias("w")))
    return (materialize(sent.unionByName(returned), "transition", replaces=[flagged]),
            fan_out.select("src", (F.col("n") + 1).alias("n")))


def _propagate(shares: DataFrame, fan_out: DataFrame, state: DataFrame, start: int, end: int, base: str | None,
               task_rows: int, tol: float | None = None, manifest: dict[str, str] | None = None) -> DataFrame:
    """(id, source, score): the state after the iterations, nodes of score 0 left out.

    The shares are laid out by their source once; an iteration moves the scores to them.
    """
    hot, key = hot_keys(fan_out, ["src"], task_rows=task_rows), ["src"]
    flat = shares
    if hot is not None:
        flat, key = spread_rows(shares, ["src"], ["dst"], hot), ["src", "salt"]
    laid_out = materialize(flat, "shares", replaces=[shares], keyed_by=key)

    def step(ranks: DataFrame) -> DataFrame:
        senders = ranks.withColumnRenamed("id", "src")
        if hot is not None:
            senders = copy_rows(senders, ["src"], hot)
        return (laid_out.join(senders, key)
                .groupBy(F.coalesce("dst", "source").alias("id"), "source")
                .agg(F.sum(F.col("score") * F.col("w")).alias("score")))

    if tol is None:
        reached = iterate(state, step, start, end, base=base, manifest=manifest)
        release(laid_out)
        return reached
    for _ in range(start, end):
        after = materialize(step(state), "iter")
        old = state.withColumnRenamed("score", "old")
        change = F.abs(F.coalesce("score", F.lit(0.0)) - F.coalesce("old", F.lit(0.0)))
        moved = after.join(old, ["id", "source"], "full").agg(F.sum(change)).first()[0]
        release(state)
        state = after
        if moved < tol:
            break
    release(laid_out)
    return state


def personalized_pagerank(nodes: DataFrame, edges: DataFrame, sources: list[int],
                          iterations: int, alpha: float = ALPHA, *, base: str | None = None,
                          start: int | None = 0, task_rows: int = TASK_ROWS) -> DataFrame:
    """(source, id, score) of every node for every source.

    All sources advance together. With ``base`` the state of each iteration is kept as
    ``base/iterNNNN`` and ``start`` resumes from a stored one. A state counts once its
    manifest stands, which is written last; a run resumes only where the manifest names
    the same sources, alpha and graph. ``start=None`` takes the last whole state, or begins
    anew where there is none.
    """
    records = build_rank_records(nodes, sources)
    if base is None and start != 0:
        raise ValueError("a run can only be resumed from stored states")
    manifest = None if base is None else {
        "sources": ",".join(map(str, sorted(set(sources)))), "alpha": repr(float(alpha)),
        **_fingerprint(nodes, edges)}
    if start is None:
        start = last_state(nodes.sparkSession, base, iterations)
    if start:
        check_state(nodes.sparkSession, base, start, manifest)
    shares, fan_out = _transition(nodes, edges, alpha, task_rows)
    reached = _propagate(shares, fan_out, records.where(F.col("score") > 0), start, iterations, base,
                         task_rows, manifest=manifest)
    return (records.select("source", "id")
            .join(reached, ["id", "source"], "left")
            .select("source", "id", F.coalesce("score", F.lit(0.0)).alias("score")))


def _fingerprint(nodes: DataFrame, edges: DataFrame) -> dict[str, str]:
    """Counts and order-free hashes of a graph's nodes and edges."""
    def summed(rows: DataFrame, *columns: str) -> str:
        mixed = F.sum(F.xxhash64(*columns).cast("decimal(20,0)"))
        count, total = rows.agg(F.count(F.lit(1)), mixed).first()
        return f"{count}:{total or 0}"

    return {"nodes": summed(nodes, "id"), "edges": summed(edges, "src", "dst")}


def missing_mass(nodes: DataFrame, edges: DataFrame, ranks: DataFrame, *,
                 task_rows: int = TASK_ROWS) -> DataFrame:
    """(source, missing): the score one step would lose at nodes without out-links
    and on edges to unknown nodes."""
    shares, _ = _transition(nodes, edges, 0.0, task_rows)
    lost = shares.where(F.col("dst").isNull()).select(F.col("src").alias("id"), "w")
    return (ranks.join(lost, "id").groupBy("source")
            .agg(F.sum(F.col("score") * F.col("w")).alias("missing")))


def log_scores(ranks: DataFrame) -> DataFrame:
    """(source, id, log_score): natural logs; a score of 0 has none and is left out."""
    return (ranks.where(F.col("score") > 0)
            .select("source", "id", F.ln("score").alias("log_score")))


def pagerank(nodes: DataFrame, edges: DataFrame, iterations: int, alpha: float = ALPHA, *,
             tol: float | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """(id, score): PageRank with a uniform start, jump and spread of missing score.

    A virtual node stands for "any node": it is the one source, holds the whole
    score at first, and passes on to each node the average of what all nodes pass
    to it. A node's score is its own plus an even part of the virtual node's. With
    ``tol`` the iterations stop once the scores move by less than that in total.
    """
    count, least = nodes.agg(F.count(F.lit(1)), F.min("id")).first()
    if not count:
        raise ValueError("the graph has no nodes")
    virtual = F.lit(least - 1).cast("bigint")
    shares, fan_out = _transition(nodes, edges, alpha, task_rows)
    average = (shares.groupBy("dst").agg((F.sum("w") / F.lit(count)).alias("w"))
               .select(virtual.alias("src"), "dst", "w"))
    fan_out = fan_out.unionByName(nodes.sparkSession.range(1).select(
        virtual.alias("src"), F.lit(count + 1).cast("bigint").alias("n")))
    every = materialize(shares.unionByName(average), "with-virtual", replaces=[shares])
    # The first step is known: the virtual node passes its whole score on.
    sent = (every.where(F.col("src") == virtual)
            .select(F.coalesce("dst", virtual).alias("id"), virtual.alias("source"),
                    F.col("w").alias("score")))
    if iterations < 1:
        return nodes.select("id", F.lit(1.0 / count).alias("score"))
    first = materialize(sent, "first")
    reached = _propagate(every, fan_out, first, 1, iterations, None, task_rows, tol)
    # The virtual node is absent when nothing returned to it, which alpha = 0 allows.
    held = reached.where(F.col("id") == virtual).agg(F.coalesce(F.sum("score"), F.lit(0.0))).scalar()
    return (nodes.join(reached.select("id", "score"), "id", "left")
            .select("id", (F.coalesce("score", F.lit(0.0)) + held / F.lit(count)).alias("score")))


def converged_pagerank(nodes: DataFrame, edges: DataFrame, tol: float = 1e-9, alpha: float = ALPHA, *,
                       max_rounds: int = 1000, task_rows: int = TASK_ROWS,
                       rounds: list[int] | None = None) -> DataFrame:
    """(id, score): PageRank as it is after any number of iterations, to ``tol`` in total.

    Residuals are pushed: a node adds its residual to its score and passes it on along its
    edges, but only while it exceeds its share of the tolerance. Scores that have settled
    send nothing, so messages fall from round to round, and the residuals left at the end
    bound the error. What is lost at nodes without out-links and on edges to unknown nodes
    goes evenly to all nodes, as the start does, so it only scales the scores: they are
    brought to a sum of 1 at the end. ``rounds`` is filled with the senders of each round.
    Raises ValueError where the bound isn't reached in ``max_rounds``.
    """
    count = nodes.count()
    if not count:
        raise ValueError("the graph has no nodes")
    shares, fan_out = _transition(nodes, edges, alpha, task_rows)
    hot, key = hot_keys(fan_out, ["src"], task_rows=task_rows), ["src"]
    sent = shares.where("dst IS NOT NULL")
    if hot is not None:
        sent, key = spread_rows(sent, ["src"], ["dst"], hot), ["src", "salt"]
    laid_out = materialize(sent, "shares", replaces=[shares], keyed_by=key)
    # Residuals sum to 1 at first and shrink by alpha at least; scores sum to 1 / alpha at most.
    bound = F.lit(tol * alpha / count)
    active = F.col("residual") > bound
    state = materialize(nodes.select("id", F.lit(0.0).alias("score"), F.lit(1.0 / count).alias("residual")), "push")
    for _ in range(max_rounds):
        senders = state.where(active).count()
        if not senders:
            break
        if rounds is not None:
            rounds.append(senders)
        pushed = state.where(active).select(F.col("id").alias("src"), "residual")
        if hot is not None:
            pushed = copy_rows(pushed, ["src"], hot)
        # Residuals that are all alike take little room on disk: by the size of their file they
        # would be sent to the driver whole.
        messages = laid_out.join(pushed.hint("shuffle_hash"), key).select(
            F.col("dst").alias("id"), F.lit(0.0).alias("score"), (F.col("residual") * F.col("w")).alias("residual"))
        held = state.select("id", F.when(active, F.col("score") + F.col("residual")).otherwise(F.col("score")).alias("score"),
                            F.when(active, F.lit(0.0)).otherwise(F.col("residual")).alias("residual"))
        after = held.unionByName(messages).groupBy("id").agg(F.sum("score").alias("score"), F.sum("residual").alias("residual"))
        state = materialize(after, "push", replaces=[state])
    else:
        raise ValueError(f"residuals above the bound after {max_rounds} rounds")
    release(laid_out)
    total = state.agg(F.sum("score")).first()[0]
    return state.select("id", (F.col("score") / F.lit(total)).alias("score"))


def log_messages(nodes: DataFrame, edges: DataFrame, logs: DataFrame, alpha: float = ALPHA, *,
                 task_rows: int = TASK_ROWS) -> DataFrame:
    """(source, id, log_score): one propagation step on logs of scores (source, id, log_score).

    What reaches a node along edges, as :func:`personalized_pagerank` sends it before the
    jump; a node nothing reaches has no row. Scores too small for a double keep their logs.
    """
    shares, fan_out = _transition(nodes, edges, alpha, task_rows)
    sent = shares.where("dst IS NOT NULL").select(F.col("src").alias("from"), F.col("dst").alias("id"),
                                                  F.ln("w").alias("log_w"))
    weights = fan_out.withColumnRenamed("src", "from")
    moved = skew_join(sent, logs.withColumnRenamed("id", "from"), ["from"], weights, by=["id"], task_rows=task_rows)
    return log_sum_exp(moved.select("source", "id", (F.col("log_score") + F.col("log_w")).alias("log")),
                       ["source", "id"], "log", "log_score")


def dump_ranks(ranks: DataFrame, edges: DataFrame, span: int = 1_000_000) -> DataFrame:
    """(value): text lines ``id, source, score, block, neighbours``, tab-separated.

    The neighbours follow in id order, a repeated one as often as it is listed. A line
    takes the neighbours of one block of ``span`` ids, so a hub fills several lines; a
    node without neighbours has one line of block 0.
    """
    blocks = (edges.select(F.col("src").alias("id"), "dst")
              .groupBy("id", block_of("dst", span).alias("block"))
              .agg(F.sort_array(F.collect_list("dst")).alias("nbrs")))
    listed = F.array_join(F.col("nbrs").cast("array<string>"), " ")
    return (ranks.join(blocks.select("id", "block", listed.alias("nbrs")), "id", "left")
            .select(F.concat_ws("\t", F.col("id").cast("string"), F.col("source").cast("string"),
                                F.format_string("%.6f", "score"),
                                F.coalesce("block", F.lit(0)).cast("string"),
                                F.coalesce("nbrs", F.lit(""))).alias("value")))
