"""Word and document frequencies, vocabulary questions and term ids.

``lines`` is ``(docno BIGINT, text STRING)`` with one row per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corvane.functions.tokens import (
    SPACE_DELIMITERS,
    WORD_DELIMITERS,
    distinct_tokens,
    is_alphabetic,
    token_runs,
    tokens,
)
from corvane.plans.ids import dense_ids


def word_count(lines: DataFrame) -> DataFrame:
    """(term, cnt): occurrences of every token."""
    return (lines.select(F.explode(tokens("text")).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("cnt")))


def word_count_alpha(lines: DataFrame) -> DataFrame:
    """(term, cnt) over tokens made of the letters A-Z and a-z only."""
    return (lines.select(F.explode(tokens("text")).alias("term"))
            .where(is_alphabetic("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("cnt")))


def document_frequency(lines: DataFrame, delimiters: str = WORD_DELIMITERS) -> DataFrame:
    """(term, df): number of lines that contain the term."""
    return (lines.select(F.explode(distinct_tokens("text", delimiters)).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("df")))


def term_frequency(lines: DataFrame) -> DataFrame:
    """(term, docno, tf): histogram of the terms inside each line.

    A line is one row, so its histogram is built in place and nothing is shuffled.
    """
    return token_runs(lines, SPACE_DELIMITERS)


def vocabulary_size(counts: DataFrame) -> DataFrame:
    """(n): number of distinct terms of a word count."""
    return counts.agg(F.count(F.lit(1)).alias("n"))


def vocabulary_edges(counts: DataFrame, k: int = 3) -> DataFrame:
    """(place, term, cnt): the first and the k-th to last term in byte order.

    With fewer than ``k`` terms there is no k-th to last one.
    """
    first = counts.orderBy("term").limit(1).withColumn("place", F.lit("first"))
    # The window sees the k rows of the limit.
    tail = (counts.orderBy(F.desc("term")).limit(k)
            .withColumn("from_end", F.row_number().over(Window.orderBy(F.desc("term")))))
    last = tail.where(F.col("from_end") == k).withColumn("place", F.lit(f"last_{k}"))
    names = ["place", "term", "cnt"]
    return first.select(names).unionByName(last.select(names))


def term_recount(counts: DataFrame) -> DataFrame:
    """(term, n): rows per term in a merged word count; 1 everywhere when it is sound."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def term_ids_by_frequency(lines: DataFrame) -> DataFrame:
    """(term, id): ids 1..V by falling count, ties in byte order of the term."""
    ids = dense_ids(word_count(lines), [F.desc("cnt"), F.asc("term")])
    return ids.select("term", "id")


def term_ids_alphabetical(lines: DataFrame) -> DataFrame:
    """(term, id): ids 1..V of the distinct terms in byte order."""
    terms = lines.select(F.explode(tokens("text")).alias("term")).distinct()
    return dense_ids(terms, [F.asc("term")])
