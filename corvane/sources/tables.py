"""Logical inputs of the operators read from the driver's tables.

Every binding covers its tables as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

# More than any text can have: a line number within a text is a 32-bit position.
DOC_LINES = 1 << 31


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """(docno, text): every line of every document; docno = doc_id * 2147483648 + line.

    ``partitions`` deals the documents over as many tasks, for a file that is one split.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    if partitions is not None:
        documents = documents.repartition(partitions, "doc_id")
    rows = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    return rows.select((F.col("doc_id") * DOC_LINES + F.col("line")).alias("docno"), "text")


def line_fetcher(spark: SparkSession, sf_dir: str) -> Callable[[DataFrame], DataFrame]:
    """A function from (docno) rows, each docno once, to their (docno, text) lines.

    The document is part of the docno: documents are joined first and only those asked
    for are split.
    """
    def fetch(docnos: DataFrame) -> DataFrame:
        asked = (docnos.select(F.expr(f"docno div {DOC_LINES}L").alias("doc_id"),
                               (F.col("docno") % DOC_LINES).cast("int").alias("line"))
                 .groupBy("doc_id").agg(F.collect_list("line").alias("asked")))
        parts = (table(spark, sf_dir, "documents").join(asked, "doc_id")
                 .select("doc_id", "asked", F.split("text", "\n").alias("parts")))
        return (parts.select("doc_id", "parts", F.explode("asked").alias("line"))
                .select((F.col("doc_id") * DOC_LINES + F.col("line")).alias("docno"),
                        F.get("parts", F.col("line")).alias("text")))

    return fetch


def observations(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """(k, v): line quantities per supplier, order or part."""
    return table(spark, sf_dir, "lineitem").select(
        F.col(key).cast("string").alias("k"), F.col("l_quantity").cast("int").alias("v"))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, content): the events, content being the type and the properties."""
    return table(spark, sf_dir, "events").select(
        "ts", F.concat_ws(" ", "event_type", "props").alias("content"))


def text_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, content): the events with their time as log date text."""
    date = F.date_format("ts", "EEE MMM dd HH:mm:ss '+0000' yyyy")
    return log(spark, sf_dir).select(date.alias("date"), "content")


def _next_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(a, b): parts on following lines of one order, each pair of parts once."""
    items = table(spark, sf_dir, "lineitem")
    here = items.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("a"))
    after = items.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"),
                         F.col("l_partkey").alias("b"))
    return (here.join(after, ["l_orderkey", "l_linenumber"])
            .where(F.col("a") != F.col("b")).select("a", "b").distinct())


def part_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst): parts on neighbouring lines of an order, in both directions."""
    turns = F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")),
                    F.struct(F.col("b").alias("src"), F.col("a").alias("dst")))
    return (_next_parts(spark, sf_dir).select(F.explode(turns).alias("t"))
            .select("t.src", "t.dst").distinct())


def purchase_flow(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Directed graph of parts, their buyers and their suppliers.

    A part points to the parts on the next line of an order, to a customer once for
    every line they bought it on, and once to each supplier. Ids are 3 * key plus 0 for
    parts, 1 for customers, 2 for suppliers. Customers are nodes without out-links
    and suppliers are not listed as nodes.
    """
    items = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    follows = _next_parts(spark, sf_dir).select((F.col("a") * 3).alias("src"),
                                                (F.col("b") * 3).alias("dst"))
    buyers = (items.join(orders, items.l_orderkey == orders.o_orderkey)
              .select((F.col("l_partkey") * 3).alias("src"),
                      (F.col("o_custkey") * 3 + 1).alias("dst")))
    suppliers = items.select((F.col("l_partkey") * 3).alias("src"),
                             (F.col("l_suppkey") * 3 + 2).alias("dst")).distinct()
    parts = table(spark, sf_dir, "part").select((F.col("p_partkey") * 3).alias("id"))
    customers = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 3 + 1).alias("id"))
    return parts.unionByName(customers), follows.unionByName(buyers).unionByName(suppliers)


def key_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Foreign-key graph: order to customer, customer and supplier to nation, nation
    to region; parts stand alone. Ids are 6 * key plus a digit for the table."""
    def ids(name: str, key: str, digit: int) -> DataFrame:
        return table(spark, sf_dir, name).select(_tagged(key, digit).alias("id"))

    def links(name: str, key: str, digit: int, other: str, other_digit: int) -> DataFrame:
        return table(spark, sf_dir, name).select(_tagged(key, digit).alias("src"),
                                                 _tagged(other, other_digit).alias("dst"))

    nodes = ids("region", "r_regionkey", 0)
    for name, key, digit in [("nation", "n_nationkey", 1), ("customer", "c_custkey", 2),
                             ("supplier", "s_suppkey", 3), ("orders", "o_orderkey", 4),
                             ("part", "p_partkey", 5)]:
        nodes = nodes.unionByName(ids(name, key, digit))
    edges = (links("nation", "n_nationkey", 1, "n_regionkey", 0)
             .unionByName(links("customer", "c_custkey", 2, "c_nationkey", 1))
             .unionByName(links("supplier", "s_suppkey", 3, "s_nationkey", 1))
             .unionByName(links("orders", "o_orderkey", 4, "o_custkey", 2)))
    return nodes, edges


def _tagged(key: str, digit: int):
    return F.col(key).cast("bigint") * 6 + digit
