"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set is its distinct word shingles. ``TREES`` groups of ``DEPTH`` minimum
hashes each give a sorted order of the sets; sets that stand side by side share the
longest prefixes, however deep the region they lie in, and become candidates when
they share ``LEAST`` values. Nothing is paired inside a region, so the candidates of a
region of any size grow with its members only.

Links are confirmed on the full sets in three rounds, each over what the rounds before
left in different components: every set with the neighbour whose signature agrees best,
then all neighbours, then the members of a region of ``LEAST`` shared values, block
against block inside the tasks. Pairs whose signatures agree in fewer than
``agree_floor`` places are not compared: for a linked pair that is four standard
deviations off.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from corvane.llm.common import Memo, map_rows
from corvane.operators.components import weakly_connected_components
from corvane.plans.scratch import materialize, release

TREES, DEPTH, LEAST = 8, 8, 3
VALUES = TREES * DEPTH
SHINGLE_WORDS = 3
PERCENT = 85
BLOCK_ROWS = 512
BLOCK_BYTES = 1 << 24
SPACE = re.compile(rb"[\x20\x09-\x0D]+")

_random = np.random.default_rng(20240229)
FACTORS = _random.integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(0, 1 << 63, VALUES, dtype=np.uint64)


def agree_floor(percent: int) -> int:
    """Least number of agreeing signature values of a pair worth comparing."""
    p = percent / 100
    return max(1, math.floor(VALUES * p - 4 * math.sqrt(VALUES * p * (1 - p))))


def shingle_set(text: str | None, words: int, memo: Memo) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; A-Z fold to a-z."""
    tokens = [t for t in SPACE.split((text or "").encode("utf-8", "surrogatepass").lower()) if t]
    if not tokens:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))
    width = min(words, len(ids))
    size = len(ids) - width + 1
    rolled = np.full(size, np.uint64(width))
    for i in range(width):
        rolled = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        rolled += ids[i:i + size]
    rolled = (rolled ^ (rolled >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return np.unique(rolled ^ (rolled >> np.uint64(31)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over the set, big-endian so that bytes sort."""
    least = np.full(VALUES, 0xFFFFFFFF, np.uint64)
    for start in range(0, len(shingles), 4096):
        part = shingles[start:start + 4096]
        hashed = (FACTORS[:, None] * part[None, :] + SHIFTS[:, None]) >> np.uint64(32)
        np.minimum(least, hashed.min(axis=1), out=least)
    return least.astype(">u4")


def _node(shingles: np.ndarray) -> int:
    """64-bit identity of a set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "big", signed=True)


def _word_memo() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, node, sig): node and sig are null for an empty set."""
    memo = _word_memo()

    def rows(part: dict[str, list]) -> Iterator[tuple]:
        for doc_id, text in zip(part["doc_id"], part["text"]):
            found = shingle_set(text, words, memo)
            yield (doc_id, len(found), _node(found) if len(found) else None,
                   signature(found).tobytes() if len(found) else None)

    return map_rows(docs.select("doc_id", "text"),
                    "doc_id long, n_shingles long, node long, sig binary", rows)


def _neighbours(nodes: DataFrame) -> DataFrame:
    """(a, b): sets side by side in a tree's order that share LEAST values or more.

    Each order is a range-partitioned sort, so a region of any size is dealt over
    tasks; the sets on both sides of a border between tasks are paired afterwards.
    """
    width = 4 * DEPTH
    trees = F.array(*[F.struct(F.lit(t).alias("tree"),
                               F.substring("sig", t * width + 1, width).alias("key"))
                      for t in range(TREES)])
    rows = nodes.select("node", F.explode(trees).alias("x")).select("x.tree", "x.key", "node")
    ordered = rows.repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    schema = "a long, b long, part int, opens boolean, tree int, key binary"
    arrow = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("part", pa.int32()),
                       ("opens", pa.bool_()), ("tree", pa.int32()), ("key", pa.binary())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None

        def out(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column(0).to_numpy()
            node = batch.column(2).to_numpy()
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4").reshape(-1, DEPTH)
            found = []
            if held is None:
                found.append((int(node[0]), None, part, True, int(tree[0]), keys[0].tobytes()))
            else:
                tree = np.concatenate((held[0], tree))
                node, keys = np.concatenate((held[1], node)), np.concatenate((held[2], keys))
            near = (tree[1:] == tree[:-1]) & (keys[1:, :LEAST] == keys[:-1, :LEAST]).all(axis=1)
            found += [(int(a), int(b), part, None, None, None)
                      for a, b in zip(node[:-1][near], node[1:][near])]
            if found:
                yield out(found)
            held = tree[-1:], node[-1:], keys[-1:]
        if held is not None:
            yield out([(int(held[1][0]), None, part, False, int(held[0][0]), held[2][0].tobytes())])

    found = materialize(ordered.mapInArrow(walk, schema), "neighbours")
    # One light row for each border between tasks.
    opening = found.where("opens").select("part", F.col("a").alias("b"), "tree", "key")
    after = F.lead("part").over(Window.orderBy("part"))
    follows = opening.select("part", after.alias("after")).where("after IS NOT NULL")
    closing = found.where("NOT opens").select("part", "a", "tree", F.col("key").alias("last"))
    borders = (closing.join(follows, "part").drop("part")
               .join(opening.withColumnRenamed("part", "after"), ["after", "tree"])
               .where(F.substring("key", 1, 4 * LEAST) == F.substring("last", 1, 4 * LEAST))
               .select("a", "b"))
    return _ordered(found.where("opens IS NULL").select("a", "b").unionByName(borders))


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with a < b."""
    return (pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .where("a < b").distinct())


def _agreeing(pairs: DataFrame, nodes: DataFrame, floor: int) -> DataFrame:
    """(a, b, agree) of the pairs whose signatures agree in ``floor`` places or more."""
    both = (pairs.join(nodes.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
            .join(nodes.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b"))

    def rows(part: dict[str, list]) -> Iterator[tuple]:
        left = np.frombuffer(b"".join(part["sig_a"]), np.uint32).reshape(-1, VALUES)
        right = np.frombuffer(b"".join(part["sig_b"]), np.uint32).reshape(-1, VALUES)
        agree = (left == right).sum(axis=1)
        for a, b, n in zip(part["a"], part["b"], agree.tolist()):
            if n >= floor:
                yield a, b, n

    return map_rows(both.select("a", "b", "sig_a", "sig_b"), "a long, b long, agree int", rows, 4096)


def _sets(asked: DataFrame, docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, members): the full sets of the asked nodes, made again from their texts."""
    owners = nodes.select("node", "id").join(asked, "node")
    texts = (docs.select("doc_id", "text")
             .join(owners, F.col("doc_id").eqNullSafe(F.col("id"))).select("node", "text"))
    memo = _word_memo()

    def rows(part: dict[str, list]) -> Iterator[tuple]:
        for node, text in zip(part["node"], part["text"]):
            found = shingle_set(text, words, memo)
            if len(found) and _node(found) == node:  # rows may share an id
                yield node, found.tobytes()

    return map_rows(texts, "node long, members binary", rows)


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets, given sorted, are alike enough; the sizes alone may tell that not."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, words: int,
               percent: int) -> DataFrame:
    """The pairs whose full sets are alike enough. Only sets that occur in a pair travel."""
    full = materialize(_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(),
                             docs, nodes, words), "sets")
    both = (pairs.select("a", "b")
            .join(full.select(F.col("node").alias("a"), F.col("members").alias("left")), "a")
            .join(full.select(F.col("node").alias("b"), F.col("members").alias("right")), "b"))

    def rows(part: dict[str, list]) -> Iterator[tuple]:
        for a, b, left, right in zip(part["a"], part["b"], part["left"], part["right"]):
            if _alike(np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64), percent):
                yield a, b

    links = materialize(map_rows(both.select("a", "b", "left", "right"), "a long, b long", rows),
                        "confirmed")
    release(full)
    return links


def _components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    edges = links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    return weakly_connected_components(nodes.select(F.col("node").alias("id")), edges).select(
        F.col("id").alias("node"), "component")


def _merged(component: DataFrame, links: DataFrame) -> DataFrame:
    """``component`` with those joined that links (a, b) connect. Rounds are over the few
    components that links touch; no earlier link is read again."""
    edges = materialize(_across(links, component, "of_a AS src", "of_b AS dst").distinct(), "edges")
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    found = weakly_connected_components(ends, edges).select(
        F.col("id").alias("component"), F.col("component").alias("into"))
    return materialize(component.join(found, "component", "left").select(
        "node", F.coalesce("into", "component").alias("component")), "components", replaces=[component, edges])


def _across(pairs: DataFrame, component: DataFrame, *columns: str) -> DataFrame:
    """(a, b), or ``columns``, of the pairs whose ends lie in different components."""
    def side(end: str) -> DataFrame:
        return component.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))

    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").where(
        "of_a != of_b").selectExpr(*(columns or ("a", "b")))


def _blocks(members: DataFrame, regions: DataFrame, weight: str) -> DataFrame:
    """``members`` with a pair of blocks (``lo``, ``hi``), once for every pair a member is in.

    Members of the region's largest component need no check among themselves: their
    blocks meet the others' blocks only. A block takes about BLOCK_ROWS members or
    BLOCK_BYTES of ``weight``, so a task holds two blocks whatever a region's size.
    """
    is_main = F.col("component") == F.col("main")
    sizes = (members.join(regions, "region").groupBy("region")
             .agg(F.count_if(~is_main).alias("n_others"), F.count_if(is_main).alias("n_main"),
                  F.sum(F.when(~is_main, F.col(weight)).otherwise(0)).alias("w_others"),
                  F.sum(F.when(is_main, F.col(weight)).otherwise(0)).alias("w_main")))

    def count(kind: str):
        return F.greatest(F.ceil(F.col(f"n_{kind}") / BLOCK_ROWS), F.ceil(F.col(f"w_{kind}") / BLOCK_BYTES),
                          F.lit(1)).cast("int").alias(f"b_{kind}")

    dealt = members.join(regions.join(sizes.select("region", count("others"), count("main")), "region"), "region")
    own = F.pmod(F.xxhash64("node"), F.when(is_main, F.col("b_main")).otherwise(F.col("b_others"))).cast("int")

    def up_to(n: str):
        return F.sequence(F.lit(0), F.col(n) - 1)

    def pair(lo, hi):
        return F.struct(lo.alias("lo"), hi.alias("hi"))

    with_others = F.transform(up_to("b_others"), lambda i: pair(F.least(i, F.col("own")), F.greatest(i, F.col("own"))))
    with_main = F.transform(up_to("b_main"), lambda j: pair(F.col("own"), F.col("b_others") + j))
    of_main = F.transform(up_to("b_others"), lambda i: pair(i, F.col("b_others") + F.col("own")))
    return (dealt.withColumn("own", own)
            .withColumn("pair", F.explode(F.when(is_main, of_main).otherwise(F.concat(with_others, with_main))))
            .select("region", "pair.lo", "pair.hi",
                    F.when(is_main, F.col("b_others") + F.col("own")).otherwise(F.col("own")).alias("own"),
                    *[c for c in members.columns if c != "region"]))


def _asked(table: pa.Table, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs between a table's two blocks that have to be compared: other
    components, agreeing signatures, and no earlier tree whose region holds both."""
    own, lo, hi = (table.column(c).to_numpy() for c in ("own", "lo", "hi"))
    component, tree = table.column("component").to_numpy(), int(table.column("tree")[0].as_py())
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), ">u4").reshape(-1, VALUES).astype(np.uint32)
    left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
    agree = np.zeros((len(left), len(right)), np.int16)
    before = np.zeros(agree.shape, bool)
    for t in range(TREES):
        shared = np.ones(agree.shape, bool)
        for v in range(t * DEPTH, (t + 1) * DEPTH):
            same = sig[left, v][:, None] == sig[right, v][None, :]
            agree += same
            if v < t * DEPTH + LEAST:
                shared &= same
        if t < tree:
            before |= shared
    wanted = (agree >= floor) & ~before & (component[left][:, None] != component[right][None, :])
    if lo[0] == hi[0]:
        wanted &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
    i, j = np.nonzero(wanted)
    first = np.argsort(-agree[i, j], kind="stable")
    return left[i[first]], right[j[first]]


def _region_links(docs: DataFrame, nodes: DataFrame, component: DataFrame, words: int, percent: int,
                  floor: int) -> DataFrame:
    """(a, b) links across components inside the regions of LEAST shared values.

    Pairs are formed inside tasks, block against block, and only links leave them. A
    first pass on signatures names the sets that have a partner to be compared with; a
    second one compares full sets, most agreeing pairs first, and skips pairs that links
    of the same two blocks have joined meanwhile.
    """
    width = 4 * DEPTH
    regions = F.array(*[F.struct(F.lit(t).alias("tree"),
                                 F.xxhash64(F.lit(t), F.substring("sig", t * width + 1, 4 * LEAST)).alias("region"))
                        for t in range(TREES)])
    members = (nodes.join(component, "node").select("node", "component", "sig", F.explode(regions).alias("x"))
               .select("x.region", "x.tree", "node", "component", "sig"))
    sizes = members.groupBy("region", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = materialize(
        sizes.groupBy("region").agg(F.max_by("component", F.struct("n", "component")).alias("main"),
                                    F.count(F.lit(1)).alias("parts")).where("parts > 1").drop("parts"), "mixed")
    inside = materialize(members.join(mixed.select("region"), "region")
                         .withColumn("bytes", F.lit(4 * VALUES)), "members")

    def named(table: pa.Table) -> pa.Table:
        i, j = _asked(table, floor)
        return table.take(np.unique(np.concatenate((i, j)))).select(["region", "tree", "node", "component", "sig"])

    key = ["region", "lo", "hi"]
    flagged = (_blocks(inside, mixed, "bytes").groupBy(key)
               .applyInArrow(named, "region long, tree int, node long, component long, sig binary").distinct())
    flagged = materialize(flagged, "flagged", replaces=[inside])
    full = materialize(_sets(flagged.select("node").distinct(), docs, nodes, words), "sets")
    held = flagged.join(full, "node").withColumn("bytes", F.octet_length("members"))

    def confirmed(table: pa.Table) -> pa.Table:
        node, component = table.column("node").to_pylist(), table.column("component").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("members").to_pylist()]
        root = {c: c for c in component}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        found = []
        for i, j in zip(*_asked(table, floor)):
            a, b = find(component[i]), find(component[j])
            if a != b and _alike(sets[i], sets[j], percent):
                root[a] = b
                found.append((min(node[i], node[j]), max(node[i], node[j])))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()),
                         "b": pa.array([f[1] for f in found], pa.int64())})

    links = materialize(_blocks(held, mixed, "bytes").groupBy(key).applyInArrow(confirmed, "a long, b long")
                        .distinct(), "region_links")
    release(full, flagged, mixed)
    return links


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs`` (doc_id, text, ...).

    Two documents are linked when ``100 * intersection >= percent * union`` of their sets.
    component_id is the smallest doc_id reached; documents without words stay alone.
    Equal sets are one node of the graph, whatever their number. Rows that repeat a
    doc_id are one document each with that id; a null id is smaller than none, so a
    component has a null id only when all its ids are null (kept is then false but
    for documents without words, which are always kept).
    """
    floor = agree_floor(percent)
    found = materialize(signatures(docs, words), "signatures")
    nodes = materialize(found.where("node IS NOT NULL").groupBy("node")
                        .agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig")), "sets")
    candidates = materialize(_agreeing(_neighbours(nodes), nodes, floor), "candidates")
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
                             F.struct(F.col("b").alias("node"), F.col("a").alias("other"))))
    best = (candidates.select(ends.alias("e"), "agree").groupBy("e.node")
            .agg(F.max_by("e.other", F.struct("agree", "e.other")).alias("other"))
            .select(F.col("node").alias("a"), F.col("other").alias("b")))
    links = _confirmed(materialize(_ordered(best), "best"), docs, nodes, words, percent)
    component = materialize(_components(nodes, links), "components", replaces=[links])
    rest = materialize(_across(candidates, component), "rest")
    for more in (lambda: _confirmed(rest, docs, nodes, words, percent),
                 lambda: _region_links(docs, nodes, component, words, percent, floor)):
        links = more()
        if not links.isEmpty():
            component = _merged(component, links)
        release(links)
    names = (nodes.join(component, "node").groupBy("component")
             .agg(F.min("id").alias("component_id")))
    named = component.join(names, "component").select("node", "component_id")
    kept = (F.col("node").isNull()
            | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    return (found.drop("sig").join(named, "node", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("node").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id"),
                    kept.alias("kept")))
