import itertools
import math
import random
from collections import Counter, defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corvane.functions.measures import log_sum_exp
from corvane.operators import components, graphstats, links, pagerank, ranking
from corvane.plans import loop, scratch

DIRECTED = ([1, 2, 3, 4], [(1, 2), (1, 3), (2, 3), (2, 4), (3, 1), (3, 9)])
UNDIRECTED = {1: [2, 3], 2: [1, 3], 3: [1, 2, 4], 4: [3]}


def nodes_df(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id BIGINT")


def edges_df(spark, pairs):
    return spark.createDataFrame(list(pairs), "src BIGINT, dst BIGINT")


def from_lists(spark, lists):
    return edges_df(spark, [(s, d) for s, ds in lists.items() for d in ds])


@pytest.fixture(scope="module")
def graph(spark):
    return nodes_df(spark, DIRECTED[0]), edges_df(spark, DIRECTED[1])


def ranks_by_hand(ids, edges, source, iterations, alpha):
    """The iteration as defined, with an explicit total; source None spreads evenly."""
    out = defaultdict(list)
    for s, d in edges:
        out[s].append(d)
    r = {v: (1.0 if v == source else 0.0) if source is not None else 1 / len(ids) for v in ids}
    for _ in range(iterations):
        m = dict.fromkeys(ids, 0.0)
        for u in ids:
            for v in out[u]:
                if v in m:
                    m[v] += r[u] / len(out[u])
        missing = 1 - math.fsum(m.values())
        share = lambda v: (v == source) if source is not None else 1 / len(ids)
        r = {v: alpha * share(v) + (1 - alpha) * (m[v] + missing * share(v)) for v in ids}
    return r


def test_stats(graph):
    assert rows(graphstats.graph_stats(*graph)) == [(4, 6, 3, 1, 1)]
    assert rows(graphstats.message_stats(*graph)) == [(6, 5)]
    known = graph[0].where("id < 3")
    assert rows(graphstats.message_stats(known, graph[1])) == [(4, 3)]
    assert rows(graphstats.message_stats(known, graph[1], task_rows=1)) == [(4, 3)]
    assert rows(graphstats.message_stats(known.limit(0), graph[1])) == [(0, 0)]
    assert rows(graphstats.edge_touched_nodes(graph[1])) == [(1,), (2,), (3,), (4,), (9,)]


def test_checks(spark, graph):
    with pytest.raises(ValueError, match="listed 2 times"):
        pagerank.pagerank(nodes_df(spark, [1, 1, 2, 3]), graph[1], 1)
    with pytest.raises(ValueError, match="not listed"):
        pagerank.pagerank(nodes_df(spark, [1, 2]), graph[1], 1)
    with pytest.raises(ValueError, match=r"\[9\]"):
        pagerank.build_rank_records(graph[0], [1, 9])
    with pytest.raises(ValueError):
        pagerank.pagerank(nodes_df(spark, []), edges_df(spark, []), 1)


@pytest.mark.parametrize("source,iterations,want", [
    (1, 1, (0.15, 0.425, 0.425, 0)),
    (1, 2, (0.51125, 0.06375, 0.244375, 0.180625)),
    (1, 3, (0.51125, 0.217281, 0.244375, 0.027094)),
    (1, 10, (0.453238, 0.190011, 0.273381, 0.08337)),
    (2, 1, (0, 0.15, 0.425, 0.425)),
    (2, 2, (0.180625, 0.691875, 0.06375, 0.06375)),
    (2, 10, (0.108776, 0.47336, 0.228451, 0.189412)),
])
def test_personalized(graph, source, iterations, want):
    got = rows(pagerank.personalized_pagerank(*graph, [source], iterations))
    assert got == [(source, i + 1, pytest.approx(w, abs=2e-6)) for i, w in enumerate(want)]


@pytest.fixture(scope="module")
def random_graph(spark):
    pick = random.Random(11)
    ids = list(range(1, 41))
    edges = [(pick.choice(ids[:30]), pick.choice(ids + [77, 78])) for _ in range(150)]
    edges += [(7, d) for d in ids] * 2 + [(s, 9) for s in ids[:30]]
    return ids, edges, nodes_df(spark, ids), edges_df(spark, edges)


@pytest.mark.parametrize("task_rows", [8, 1_000_000])
def test_many_sources_and_hubs(random_graph, task_rows):
    ids, edges, nodes, links_ = random_graph
    got = rows(pagerank.personalized_pagerank(nodes, links_, [3, 35, 3], 6, 0.2, task_rows=task_rows))
    assert len(got) == 2 * len(ids)
    for source in (3, 35):
        mine = {i: s for q, i, s in got if q == source}
        assert sum(mine.values()) == pytest.approx(1, abs=1e-4)
        assert mine == pytest.approx(ranks_by_hand(ids, edges, source, 6, 0.2), abs=2e-6)


@pytest.mark.parametrize("task_rows", [8, 1_000_000])
@pytest.mark.parametrize("alpha", [0.0, 0.15])
def test_global(random_graph, task_rows, alpha):
    ids, edges, nodes, links_ = random_graph
    got = dict(rows(pagerank.pagerank(nodes, links_, 7, alpha, task_rows=task_rows)))
    assert got == pytest.approx(ranks_by_hand(ids, edges, None, 7, alpha), abs=2e-6)


def test_global_without_returns(spark):
    ring = [(1, 2), (2, 3), (3, 1)]
    got = rows(pagerank.pagerank(nodes_df(spark, [1, 2, 3]), edges_df(spark, ring), 3, 0.0))
    assert got == [(1, 0.333333), (2, 0.333333), (3, 0.333333)]


def test_global_converges(random_graph):
    ids, edges, nodes, links_ = random_graph
    got = dict(rows(pagerank.pagerank(nodes, links_, 100, tol=1e-6)))
    assert got == pytest.approx(ranks_by_hand(ids, edges, None, 100, 0.15), abs=1e-5)


def test_resume(graph, tmp_path):
    base = str(tmp_path / "run")
    pagerank.personalized_pagerank(*graph, [1, 2], 4, base=base).count()
    resumed = pagerank.personalized_pagerank(*graph, [1, 2], 10, base=base, start=4)
    straight = pagerank.personalized_pagerank(*graph, [1, 2], 10)
    assert rows(resumed) == rows(straight)
    assert (tmp_path / "run" / "iter0010").is_dir()
    with pytest.raises(ValueError, match="sources"):
        pagerank.personalized_pagerank(*graph, [1, 3], 10, base=base, start=4)
    with pytest.raises(ValueError, match="stored"):
        pagerank.personalized_pagerank(*graph, [1, 2], 10, start=4)


def test_half_written_states_do_not_count(graph, tmp_path):
    """A run takes up the last state whose manifest stands."""
    base = str(tmp_path / "run")
    pagerank.personalized_pagerank(*graph, [1, 2], 6, base=base).count()
    straight = rows(pagerank.personalized_pagerank(*graph, [1, 2], 8))
    # As if the run had died while it wrote state 6, and before the manifest of state 5.
    for part in (tmp_path / "run" / "iter0006").glob("*"):
        part.unlink()
    for i in (5, 6):
        for part in (tmp_path / "run" / f"manifest{i:04d}").glob("*"):
            part.unlink()
    (tmp_path / "run" / "manifest0006").rmdir()
    spark = graph[0].sparkSession
    assert loop.last_state(spark, base, 8) == 4
    with pytest.raises(ValueError, match="no whole state"):
        pagerank.personalized_pagerank(*graph, [1, 2], 8, base=base, start=6)
    assert rows(pagerank.personalized_pagerank(*graph, [1, 2], 8, base=base, start=None)) == straight
    assert loop.last_state(spark, base, 8) == 8
    assert loop.last_state(spark, str(tmp_path / "none"), 8) == 0


def test_states_of_other_runs_are_refused(graph, tmp_path):
    base = str(tmp_path / "run")
    nodes, edges = graph
    pagerank.personalized_pagerank(nodes, edges, [1, 2], 3, base=base).count()
    with pytest.raises(ValueError, match="alpha"):
        pagerank.personalized_pagerank(nodes, edges, [1, 2], 5, 0.2, base=base, start=3)
    with pytest.raises(ValueError, match="edges"):
        pagerank.personalized_pagerank(nodes, edges.union(edges.limit(1)), [1, 2], 5, base=base, start=3)
    with pytest.raises(ValueError, match="nodes"):
        more = nodes.union(nodes.sparkSession.range(99, 100))
        pagerank.personalized_pagerank(more, edges, [1, 2], 5, base=base, start=3)


def test_converged_pagerank(random_graph):
    ids, edges, nodes, links_ = random_graph
    senders = []
    got = dict(rows(pagerank.converged_pagerank(nodes, links_, 1e-10, rounds=senders)))
    assert got == pytest.approx(ranks_by_hand(ids, edges, None, 200, 0.15), abs=1e-6)
    assert sum(got.values()) == pytest.approx(1.0, abs=1e-4)
    assert senders[0] == len(ids) and senders[-1] < senders[0]
    rough = []
    pagerank.converged_pagerank(nodes, links_, 1e-3, rounds=rough)
    assert sum(rough) < sum(senders)
    split = dict(rows(pagerank.converged_pagerank(nodes, links_, 1e-10, task_rows=3)))
    assert split == pytest.approx(got, abs=1e-6)
    with pytest.raises(ValueError, match="rounds"):
        pagerank.converged_pagerank(nodes, links_, 1e-10, max_rounds=2)


def test_log_messages_of_tiny_scores(spark, graph):
    """Logs far below those of any double; shifting all shifts the sums."""
    nodes, edges = graph
    ranks = pagerank.log_scores(pagerank.personalized_pagerank(nodes, edges, [1], 3))
    plain = {(s, i): x for i, s, x in ((r.id, r.source, r.log_score)
                                       for r in pagerank.log_messages(nodes, edges, ranks).collect())}
    tiny = ranks.withColumn("log_score", F.col("log_score") - 5000.0)
    shifted = {(r.source, r.id): r.log_score for r in pagerank.log_messages(nodes, edges, tiny).collect()}
    assert plain and shifted.keys() == plain.keys()
    for key, x in plain.items():
        assert shifted[key] == pytest.approx(x - 5000.0, abs=1e-9)


@pytest.mark.parametrize("logs,want", [
    ([-1000.0, -1000.0], -1000.0 + math.log(2)), ([0.0], 0.0), ([-1000.0, 5.0], 5.0),
    ([1000.0] * 4, 1000.0 + math.log(4)), ([255.9, 256.1], 256.1 + math.log1p(math.exp(-0.2))),
    ([-0.5, None, float("-inf")], -0.5), ([-1e6, -1e6 - 1], -1e6 + math.log1p(math.exp(-1)))])
def test_log_sum_exp(spark, logs, want):
    frame = spark.createDataFrame([("k", x) for x in logs] + [("none", None), ("zero", float("-inf"))],
                                  "k STRING, l DOUBLE")
    found = log_sum_exp(frame, ["k"], "l", "s").collect()
    assert [r.k for r in found] == ["k"] and found[0].s == pytest.approx(want, rel=1e-12)


def test_repeated_nodes(spark):
    nodes = spark.createDataFrame([(1,), (2,), (2,), (3,), (3,), (3,)], "id BIGINT")
    assert rows(graphstats.repeated_nodes(nodes)) == [(2, 2), (3, 3)]


def test_no_iterations(graph):
    assert rows(pagerank.pagerank(*graph, 0)) == [(i, 0.25) for i in (1, 2, 3, 4)]


def test_tables_left_by_convergence(spark, random_graph):
    """A run keeps the newest state and what the result reads, whatever its length."""
    _, _, nodes, links_ = random_graph

    def tables():
        database = "corvane_" + spark.sparkContext.applicationId.replace("-", "_")
        return {r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()}

    before = tables()
    pagerank.pagerank(nodes, links_, 30, tol=1e-9).count()
    kinds = sorted(t.rsplit("_", 1)[0] for t in tables() - before)
    assert kinds == ["fan_out", "iter"]


def test_edges_are_laid_out_once(random_graph):
    """An iteration shuffles scores only: the stored shares are read in their buckets."""
    _, _, nodes, links_ = random_graph
    shares, fan_out = pagerank._transition(nodes, links_, 0.15, 1_000_000)
    laid_out = scratch.materialize(shares, "shares", keyed_by=["src"])
    ranks = nodes.select(F.col("id").alias("src"), F.lit(1.0).alias("score"))
    plan = laid_out.join(ranks.hint("merge"), "src")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_reports(graph):
    ranks = pagerank.personalized_pagerank(*graph, [1], 1)
    top = ranking.top_n_per_source(ranks, 2)
    assert rows(top) == [(1, 1, 2, 0.425), (1, 2, 3, 0.425)]
    assert [r.line for r in ranking.top_report(top).collect()] == [
        "Source: 1", "0.42500 2", "0.42500 3"]
    assert [r.id for r in ranking.rank_all(ranks).collect()] == [2, 3, 1, 4]
    assert [r[0] for r in rows(pagerank.dump_ranks(ranks, graph[1]))] == [
        "1\t1\t0.150000\t0\t2 3", "2\t1\t0.425000\t0\t3 4", "3\t1\t0.425000\t0\t1 9",
        "4\t1\t0.000000\t0\t"]


def test_dump_of_repeated_and_many_neighbours(spark):
    ranks = spark.createDataFrame([(1, 1, 1.0)], "source BIGINT, id BIGINT, score DOUBLE")
    edges = edges_df(spark, [(1, 2), (1, 2), (1, -3), (1, 12)])
    assert [r[0] for r in rows(pagerank.dump_ranks(ranks, edges, span=10))] == [
        "1\t1\t1.000000\t-1\t-3", "1\t1\t1.000000\t0\t2 2", "1\t1\t1.000000\t1\t12"]


def test_two_hop(spark):
    edges = from_lists(spark, UNDIRECTED)
    every = nodes_df(spark, [1, 2, 3, 4])
    assert rows(links.two_hop_neighbors(edges, every), "node", "nbrs") == [
        (1, [2, 3, 4]), (2, [1, 3, 4]), (3, [1, 2]), (4, [1, 2])]
    assert rows(links.two_hop_neighbors(edges, every, exclude_direct=True), "node", "nbrs") == [
        (1, [4]), (2, [4]), (3, []), (4, [1, 2])]
    some = nodes_df(spark, [3, 3, 99])
    assert rows(links.two_hop_neighbors(edges, some), "node", "nbrs") == [(3, [1, 2])]
    assert links.two_hop_neighbors(edges, some.limit(0)).isEmpty()


def test_clustering(spark):
    edges = from_lists(spark, UNDIRECTED)
    assert rows(links.clustering_compat(edges)) == [(1, 1, 3), (2, 1, 3), (3, 1, 6), (4, 0, 1)]
    assert rows(links.clustering_coefficient(edges)) == [
        (1, 1, 1, 1.0), (2, 1, 1, 1.0), (3, 1, 3, 0.333333), (4, 0, 0, None)]


def two_hop_by_hand(lists):
    one, two = defaultdict(set), defaultdict(set)
    for s, ds in lists.items():
        one[s].update(ds)
        for i, j in itertools.permutations(range(len(ds)), 2):
            two[ds[i]].add(ds[j])
    return one, two


@pytest.mark.parametrize("limit", [4, 1_000_000])
@pytest.mark.parametrize("seed,loops", [(1, False), (2, True), (3, True)])
def test_neighbourhoods_of_directed_lists(spark, seed, loops, limit):
    pick = random.Random(seed)
    lists = {s: [d for d in pick.choices(range(18), k=pick.randint(1, 6)) if loops or d != s] or [s + 1]
             for s in range(14)}
    lists[0] = list(range(1, 18))
    edges = from_lists(spark, lists)
    one, two = two_hop_by_hand(lists)
    pairs = sorted((n, m) for n in two for m in two[n])
    every = nodes_df(spark, sorted(set(one) | set(two)))
    assert sorted(rows(links.two_hop_pairs(edges, every, task_pairs=limit))) == pairs
    some = every.where("id % 3 = 0")
    assert sorted(rows(links.two_hop_pairs(edges, some, task_pairs=limit))) == [p for p in pairs if p[0] % 3 == 0]
    blocks = rows(links.two_hop_neighbors(edges, every, span=5, task_pairs=limit))
    assert sorted((n, m) for n, _, ms in blocks for m in ms) == pairs
    assert all(len(ms) <= 5 and ms == sorted(ms) for _, _, ms in blocks)
    assert {n for n, b, _ in blocks if b == 0} >= set(one)
    nonempty = rows(links.two_hop_neighbors_nonempty(edges, every, task_pairs=limit), "node")
    assert {r[0] for r in nonempty} == {n for n in two if two[n]}
    keys = set(one) | {n for n in two if two[n]}
    want = sorted((n, len(one[n] & two[n]) // 2, len(one[n]) * (len(one[n]) + 1) // 2) for n in keys)
    assert sorted(rows(links.clustering_compat(edges, task_rows=limit, task_pairs=limit))) == want


@pytest.mark.parametrize("limit", [4, 1_000_000])
def test_standard_clustering_of_random_graph(spark, limit):
    pick = random.Random(9)
    near = defaultdict(set)
    for _ in range(70):
        a, b = pick.sample(range(20), 2)
        near[a].add(b)
        near[b].add(a)
    edges = from_lists(spark, {a: sorted(bs) for a, bs in near.items()})
    want = []
    for a, bs in near.items():
        links_ = sum(1 for x, y in itertools.combinations(bs, 2) if y in near[x])
        most = len(bs) * (len(bs) - 1) // 2
        want.append((a, links_, most, round(links_ / most, 6) if most else None))
    got = rows(links.clustering_coefficient(edges, task_rows=limit, task_pairs=limit))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("task_rows", [5, 1_000_000])
def test_components(spark, task_rows):
    pick = random.Random(4)
    ids = list(range(120))
    path = [(i, i + 1) for i in range(20, 60)]
    star = [(i, 100) for i in range(80, 100)]
    loose = [(pick.randrange(100, 120), pick.randrange(100, 120)) for _ in range(8)]
    edges = path + star + loose + [(3, 3), (5, 500), (6, 500)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = components.weakly_connected_components(nodes_df(spark, ids), edges_df(spark, edges),
                                                 task_rows=task_rows)
    assert sorted(rows(got)) == [(i, root(i)) for i in ids]
    assert rows(components.component_count(got)) == [(len({root(i) for i in ids}),)]


def test_no_edges(spark):
    got = components.weakly_connected_components(nodes_df(spark, [4, 2]), edges_df(spark, []))
    assert rows(got) == [(2, 2), (4, 4)]


def test_counter_matches(random_graph):
    _, edges, _, links_ = random_graph
    got = dict(rows(links_.groupBy("dst").count()))
    assert got == Counter(d for _, d in edges)


def test_converged_pagerank_sends_no_state_to_the_driver(spark, tmp_path, monkeypatch):
    joins = []
    keep = pagerank.materialize

    def kept(df, name, *args, **options):
        if name == "push":
            joins.append(df._jdf.queryExecution().sparkPlan().toString())
        return keep(df, name, *args, **options)

    monkeypatch.setattr(pagerank, "materialize", kept)
    nodes = spark.range(50)
    edges = nodes.select(F.col("id").alias("src"), ((F.col("id") * 7 + 1) % 50).alias("dst"))
    total = pagerank.converged_pagerank(nodes, edges, tol=1e-3).agg(F.sum("score")).first()[0]
    assert abs(total - 1) < 1e-9
    assert len(joins) > 2 and not any("BroadcastHashJoin" in plan for plan in joins)
