"""Boolean retrieval by set algebra on bitmaps.

Lines get dense numbers; a term's lines are bitmaps of one bit a number, a row for each
run of 32,768 numbers that holds any. AND and OR work on these rows, so a query touches
one row for each term and run, not one for each posting.

A bitmap index is ``lines (docno, number)`` and ``terms (term, bucket, bits BINARY)``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from corvane.functions.tokens import distinct_tokens
from corvane.operators.retrieval import AND, OR, Fetch, _with_text
from corvane.plans.ids import dense_ids
from corvane.plans.scratch import materialize

# Bits of one bitmap, as the built-in bitmap functions lay them out.
BUCKET_BITS = 32_768


class BitmapIndex(NamedTuple):
    lines: DataFrame
    terms: DataFrame


def build_bitmap_index(lines: DataFrame) -> BitmapIndex:
    """Bitmaps of the lines of every term, both tables stored."""
    numbered = materialize(dense_ids(lines.select("docno", "text"), [F.asc("docno")], "number"), "numbered")
    found = numbered.select("number", F.explode(distinct_tokens("text")).alias("term"))
    bits = found.groupBy("term", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    return BitmapIndex(numbered.select("docno", "number"), materialize(bits, "bitmaps"))


class _Node(NamedTuple):
    id: int
    token: str
    parent: int | None
    height: int


def _tree(qid: int, postfix: str, first: int) -> list[_Node]:
    """Nodes of a postfix query, numbered from ``first``; the last one is its root."""
    nodes: list[_Node] = []
    stack: list[int] = []
    for token in postfix.split():
        height = 0
        if token in (AND, OR):
            if len(stack) < 2:
                raise ValueError(f"operator without two operands in query: {postfix!r}")
            at = first + len(nodes)
            for child in (stack.pop(), stack.pop()):
                held = nodes[child - first]
                nodes[child - first] = held._replace(parent=at)
                height = max(height, held.height + 1)
        stack.append(first + len(nodes))
        nodes.append(_Node(first + len(nodes), token, None, height))
    if len(stack) != 1:
        raise ValueError(f"query must leave one result: {postfix!r}")
    return nodes


def matching_bitmaps(index: BitmapIndex, queries: dict[int, str]) -> DataFrame:
    """(qid, bucket, bits): the lines each postfix query holds for, as bitmaps.

    The queries' operators are applied by height: both operands of a node are rows of one
    bucket, joined by a bitmap aggregate. An AND needs both; an OR one.
    """
    nodes: list[_Node] = []
    roots: dict[int, int] = {}
    for qid, postfix in queries.items():
        nodes += _tree(qid, postfix, len(nodes))
        roots[nodes[-1].id] = qid
    spark = index.terms.sparkSession
    leaves = spark.createDataFrame([(n.token, n.id) for n in nodes if n.height == 0], "term string, node int")
    held = (index.terms.where(F.col("term").isin([n.token for n in nodes if n.height == 0]))
            .join(F.broadcast(leaves), "term").select("node", "bucket", "bits"))
    for height in range(1, max(n.height for n in nodes) + 1):
        up = {n.id: n.parent for n in nodes if n.parent is not None and nodes[n.parent].height == height}
        kinds = spark.createDataFrame(
            [(child, parent, nodes[parent].token == AND) for child, parent in up.items()],
            "node int, parent int, every boolean")
        joined = held.join(F.broadcast(kinds), "node", "left")
        above = (joined.where("parent IS NOT NULL").groupBy("parent", "every", "bucket")
                 .agg(F.bitmap_and_agg("bits").alias("both"), F.bitmap_or_agg("bits").alias("any"),
                      F.count(F.lit(1)).alias("n"))
                 .where("NOT every OR n = 2")
                 .select(F.col("parent").alias("node"), "bucket", F.expr("IF(every, both, any)").alias("bits")))
        held = joined.where("parent IS NULL").select("node", "bucket", "bits").unionByName(above)
    named = spark.createDataFrame(list(roots.items()), "node int, qid int")
    return held.join(F.broadcast(named), "node").select("qid", "bucket", "bits")


def numbers_of(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """(keys…, number): the set bits. Bytes of zeros make no row."""
    size = BUCKET_BITS // 8
    byte = F.expr("ascii(decode(substring(bits, at, 1), 'ISO-8859-1'))")
    places = F.filter(F.sequence(F.lit(1), F.lit(size)), lambda at: F.substring("bits", at, F.lit(1)) != F.lit(b"\0"))
    bit = F.explode(F.filter(F.sequence(F.lit(0), F.lit(7)),
                             lambda i: F.call_function("getbit", F.col("byte"), i) == 1))
    return (bitmaps.select(*keys, "bucket", "bits", F.explode(places).alias("at"))
            .select(*keys, "bucket", "at", byte.cast("bigint").alias("byte"))
            .select(*keys, "bucket", "at", bit.alias("bit"))
            # Bucket 1 holds the numbers 1 to 32,768.
            .select(*keys, ((F.col("bucket") - 1) * BUCKET_BITS + (F.col("at") - 1) * 8 + F.col("bit") + 1).alias("number")))


def boolean_retrieval_bitmaps(index: BitmapIndex, lines: DataFrame | Fetch, queries: dict[int, str]) -> DataFrame:
    """(qid, docno, text) of many postfix AND/OR queries, by bitmaps.

    A term the index lacks holds nowhere. Malformed queries raise ValueError.
    """
    found = numbers_of(matching_bitmaps(index, queries), "qid").join(index.lines, "number")
    return _with_text(found.select("qid", "docno"), lines).select("qid", "docno", "text")
