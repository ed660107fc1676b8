"""Merkle manifest of a dataset: a postorder append log and proofs read from it.

Rows become leaves by a hash of their fields. Within a tree leaves have places 0, 1, ...;
while several nodes remain, every two consecutive ones become their hash, the last one
alone if their number is odd.

Aligned builders take ``2 ** BLOCK_LEVELS`` consecutive leaves each and append every node to
the log the moment it is complete, so a log segment is in postorder. The segments' last
nodes are the leaves of the next round, until a tree has one node left. A node's place in
the log is never stored: of ``m`` leaves, ``2 * m - popcount(m)`` complete nodes have been
written, so the one at (level, index) stands at ``2 * (k - 1) - popcount(k - 1) + level``
with ``k = (index + 1) * 2 ** level``; nodes that stay incomplete follow at the end, level
by level. Proofs go the other way, from the last round to the first: each segment is read
once, siblings inside it are addressed by place, and those above it are the proof of the
segment's own last node.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corvane.llm.common import map_rows
from corvane.plans.ids import dense_ids
from corvane.plans.scratch import materialize
from corvane.plans.skew import skew_join

BLOCK_LEVELS = 12
DIGEST = 32
TAMPER_EVERY = 7

# A segment of the log: the nodes of ``leaves`` leaves from ``block * 2 ** BLOCK_LEVELS`` on.
SEGMENT = "tree binary, block long, leaves int, top int, nodes binary"
PATH = "tree binary, place long, proof string, sides string, subroot string, root string"


def field(name: str) -> Column:
    """A field's bytes: ``-`` for null, else the UTF-8 length, ``:`` and the value."""
    return _written(F.col(f"`{name}`").cast("string"))


def _written(value: Column) -> Column:
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(fields: list[Column]) -> Column:
    """Lower-case hex SHA-256 of the concatenated fields."""
    return F.sha2(F.concat(*fields).cast("binary"), 256)


def levels_above(leaves: int) -> int:
    """Levels from the leaves to the root."""
    return max(0, (leaves - 1).bit_length())


def place_of(level: int, index: int, leaves: int) -> int:
    """Postorder place of the node at (level, index) in a tree of ``leaves`` leaves."""
    last = (index + 1) << level
    if last <= leaves:
        return 2 * (last - 1) - (last - 1).bit_count() + level
    whole = (leaves & -leaves).bit_length() - 1  # levels up to here end in a complete node
    return 2 * leaves - leaves.bit_count() + level - whole - 1


def nodes_on(level: int, leaves: int) -> int:
    return -(-leaves >> level) if leaves else 0


def _hash(left: bytes, right: bytes | None = None) -> bytes:
    """Hash of one or two digests, read as hex text."""
    return sha256(left.hex().encode() + (right.hex().encode() if right is not None else b"")).digest()


def append_log(leaves: list[bytes], top: int) -> bytes:
    """Nodes up to level ``top`` in completion order."""
    out, open_nodes = [], []  # open_nodes: (level, digest), levels fall
    for digest in leaves:
        level = 0
        out.append(digest)
        while level < top and open_nodes and open_nodes[-1][0] == level:
            digest = _hash(open_nodes.pop()[1], digest)
            level += 1
            out.append(digest)
        open_nodes.append((level, digest))
    level, digest = open_nodes.pop()
    while level < top:
        if open_nodes and open_nodes[-1][0] == level:
            digest = _hash(open_nodes.pop()[1], digest)
        else:
            digest = _hash(digest)
        level += 1
        out.append(digest)
    return b"".join(out)


def siblings(index: int, leaves: int, top: int) -> Iterator[tuple[str, int | None]]:
    """(side, place) of the sibling on each level; side is l, r, or - where there is none."""
    for level in range(top):
        other = index ^ 1
        if other < nodes_on(level, leaves):
            yield "l" if other < index else "r", place_of(level, other, leaves)
        else:
            yield "-", None
        index >>= 1


def fold(leaf: str, proof: str, sides: str) -> str:
    """Root that a leaf and its proof lead to. ``proof`` holds the siblings' hex digests,
    one for each l and r in ``sides``."""
    node, at = leaf, 0
    for side in sides:
        if side == "-":
            text = node
        else:
            other = proof[at:at + 2 * DIGEST]
            at += 2 * DIGEST
            text = other + node if side == "l" else node + other
        node = sha256(text.encode()).hexdigest()
    return node


def _round(leaves: DataFrame, block_levels: int) -> DataFrame:
    """Log segments of (tree, place, leaves, digest) rows; ``leaves`` is the tree's number."""
    size = 1 << block_levels

    def build(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("place").to_pylist(), table.column("digest").to_pylist()))
        total = table.column("leaves")[0].as_py()
        top = min(block_levels, levels_above(total))
        return pa.table({
            "tree": pa.array([table.column("tree")[0].as_py()], pa.binary()),
            "block": pa.array([rows[0][0] >> block_levels], pa.int64()),
            "leaves": pa.array([len(rows)], pa.int32()), "top": pa.array([top], pa.int32()),
            "nodes": pa.array([append_log([digest for _, digest in rows], top)], pa.binary())})

    block = F.floor(F.col("place") / F.lit(size)).cast("bigint")
    return leaves.groupBy("tree", block.alias("block")).applyInArrow(build, SEGMENT)


def grow(leaves: DataFrame, block_levels: int = BLOCK_LEVELS) -> list[DataFrame]:
    """Log segments of every round, stored. ``leaves`` has (tree, place, leaves, digest).

    A round shrinks a tree by ``2 ** block_levels``; rounds are few: two reach 16 million
    leaves, three 68 thousand millions.
    """
    deepest = leaves.agg(F.max("leaves")).first()[0]
    rounds = []
    while deepest:
        rounds.append(materialize(_round(leaves, block_levels), "log"))
        if deepest <= 1 << block_levels:
            break
        deepest = nodes_on(block_levels, deepest)
        last = rounds[-1]
        number = F.count(F.lit(1)).over(Window.partitionBy("tree"))  # one light row for each segment
        leaves = last.select("tree", F.col("block").alias("place"), number.alias("leaves"),
                             F.substring("nodes", -DIGEST, DIGEST).alias("digest"))
    return rounds


def roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, root): digests of the trees, read from the last segment of each."""
    last = rounds[-1].where("block = 0").select("tree", F.substring("nodes", -DIGEST, DIGEST).alias("root"))
    return last


def postorder(segments: DataFrame) -> DataFrame:
    """(tree, block, place, digest): a round's log, one row a node, digests in hex."""
    count = F.expr(f"octet_length(nodes) DIV {DIGEST}")
    return segments.select("tree", "block", "nodes", F.explode(F.sequence(F.lit(0), count - 1)).alias("place")).select(
        "tree", "block", "place", F.lower(F.hex(F.expr(f"substring(nodes, place * {DIGEST} + 1, {DIGEST})"))).alias("digest"))


def paths(rounds: list[DataFrame], above: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """(tree, place, proof, sides, subroot, root) of every leaf.

    ``above`` has (tree, proof, sides, subroot, root): what follows after a tree's own root,
    empty where the tree stands alone. Every segment is read once, by one task, with one row for
    what is above it.
    """
    def read(table: pa.Table) -> Iterator[tuple]:
        for tree, block, leaves, top, nodes, proof, sides, *ends in zip(*table.values()):
            text = nodes.hex()
            width = 2 * DIGEST
            for index in range(leaves):
                own, found = [], []
                for side, place in siblings(index, leaves, top):
                    own.append(side)
                    if place is not None:
                        found.append(text[place * width:(place + 1) * width])
                yield tree, (block << block_levels) + index, "".join(found) + proof, "".join(own) + sides, *ends

    upper = above.select("tree", F.lit(0).cast("bigint").alias("block"), "proof", "sides", "subroot", "root")
    for number, segments in enumerate(reversed(rounds)):
        # Segments are rows of 256 KB at most; the batches hold few of them.
        joined = segments.join(upper, ["tree", "block"]).select(
            "tree", "block", "leaves", "top", "nodes", "proof", "sides", "subroot", "root")
        upper = map_rows(joined, PATH, read, 1)
        if number < len(rounds) - 1:
            upper = upper.withColumnRenamed("place", "block")
    return upper


def manifest(docs: DataFrame, fields: list[Column], group: str, key: str,
             also: dict[str, Column] | None = None, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """(key, [also,] leaf, proof, sides, subroot, root) of every row of ``docs``.

    Rows of equal ``group`` form a tree, in ascending order of ``key``; the trees' roots,
    ordered by group (null first, bytewise), form the tree above. ``also`` adds columns
    computed beside the leaf from the row. ``proof`` and ``sides`` are those of :func:`fold`
    and lead from the leaf over its subroot to the root.

    Null groups form a tree, null keys come first in theirs; rows that repeat a key are
    leaves of their own, ordered by their hash. Texts of any length are hashed whole and
    don't travel. An empty table has no leaves. Only the columns named are read, so other
    columns may have any names.
    """
    also = also or {}
    names = [f"also{i}_" for i in range(len(also))]
    rows = docs.select(
        F.col(f"`{group}`").cast("string").alias("group_"), F.col(f"`{key}`").alias("key_"),
        leaf_hash(fields).alias("leaf_"), *[c.alias(n) for n, c in zip(names, also.values())])
    order = [F.asc_nulls_first("group_"), F.asc_nulls_first("key_"), F.asc("leaf_"), *[F.asc(n) for n in names]]
    numbered = materialize(dense_ids(rows, order, "id_"), "leaves")
    # A tree is named by its group: no byte for null, a letter and the bytes otherwise.
    name = F.coalesce(F.concat(F.lit(b"g"), F.col("group_").cast("binary")), F.lit(b""))
    trees = materialize(
        numbered.groupBy(name.alias("tree")).agg(F.count(F.lit(1)).alias("leaves"), F.min("id_").alias("first")),
        "trees")
    placed = (skew_join(numbered.withColumn("tree", name), trees, ["tree"], trees, weight="leaves", by=["id_"])
              .withColumn("place", F.col("id_") - F.col("first")))
    rounds = grow(placed.select("tree", "place", "leaves", F.unhex("leaf_").alias("digest")), block_levels)
    columns = [F.col("key_").alias(key), *[F.col(n).alias(a) for n, a in zip(names, also)],
               F.col("leaf_").alias("leaf"), "proof", "sides", "subroot", "root"]
    if not rounds:
        return placed.withColumns({c: F.lit("") for c in ("proof", "sides", "subroot", "root")}).select(*columns)
    # The trees in order: their first leaves are ordered as the groups are.
    ranked = materialize(dense_ids(trees.join(roots(rounds), "tree"), [F.asc("first")], "rank").select(
        F.col("tree").alias("name"), (F.col("rank") - 1).alias("place"), F.col("root").alias("digest")), "ranked")
    whole = ranked.select(F.lit(b"").alias("tree"), "place", F.lit(ranked.count()).cast("bigint").alias("leaves"), "digest")
    upper_rounds = grow(whole, block_levels)
    top = roots(upper_rounds).select("tree", *[F.lit("").alias(c) for c in ("proof", "sides", "subroot")],
                                     F.lower(F.hex("root")).alias("root"))
    upper = materialize(
        paths(upper_rounds, top, block_levels).drop("tree", "subroot").join(ranked, "place")
        .select(F.col("name").alias("tree"), "proof", "sides", F.lower(F.hex("digest")).alias("subroot"), "root"),
        "upper", replaces=[ranked, *upper_rounds])
    return placed.join(paths(rounds, upper, block_levels), ["tree", "place"]).select(*columns)


def folded(rows: DataFrame, leaf: str) -> DataFrame:
    """``rows`` with ``folded_root``, from the leaf column named and ``proof`` and ``sides``."""
    names = [c for c in rows.columns if c != "folded_root"]
    schema = rows.select(*[F.col(f"`{c}`") for c in names], F.lit("").alias("folded_root")).schema
    at, proof, sides = (names.index(c) for c in (leaf, "proof", "sides"))

    def run(part: dict[str, list]) -> Iterator[tuple]:
        for row in zip(*part.values()):
            yield *row, fold(row[at], row[proof], row[sides])

    return map_rows(rows.select(*[F.col(f"`{c}`") for c in names]), schema, run, 4096)


def tampered(doc_id: str = "doc_id", every: int = TAMPER_EVERY) -> Column:
    """Whether ``every`` divides the CRC-32 of the id's decimal form; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % every == 0, F.lit(False))


def document_fields(added_chars: int = 0) -> list[Column]:
    """The fields of a ``documents`` row, with ``added_chars`` added to n_chars."""
    n_chars = F.col("n_chars").cast("decimal(20,0)") + F.lit(added_chars)  # never overflows
    return [field("doc_id"), field("source"), field("lang"), _written(n_chars.cast("string")), field("text")]


def audit(docs: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Manifest of ``documents`` with a check of every proof against a tampered row.

    (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): where
    :func:`tampered` holds, the root is folded from a leaf whose n_chars is one more (a
    null stays null, so its proof still holds). Edge cases as in :func:`manifest`.
    """
    leaf = leaf_hash(document_fields())
    seen = F.when(tampered(), leaf_hash(document_fields(1))).otherwise(leaf)
    found = folded(manifest(docs, document_fields(), "lang", "doc_id", {"seen": seen}, block_levels), "seen")
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof"), 256).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
