"""Postings lookup and boolean retrieval over an inverted index."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from corvane.operators.inverted import posting_rows

# The operator tokens of a postfix query, case-sensitive.
AND = "AND"
OR = "OR"


def query_terms(postfix: str) -> list[str]:
    """Distinct operands of a postfix query in order of appearance."""
    return list(dict.fromkeys(t for t in postfix.split() if t not in (AND, OR)))


def _condition(postfix: str, held: dict[str, Column]) -> Column:
    """The query as one boolean expression over the ``held`` flags of its terms."""
    stack: list[Column] = []
    for token in postfix.split():
        if token not in (AND, OR):
            stack.append(held[token])
            continue
        if len(stack) < 2:
            raise ValueError(f"operator without two operands in query: {postfix!r}")
        right, left = stack.pop(), stack.pop()
        stack.append(left & right if token == AND else left | right)
    if len(stack) != 1:
        raise ValueError(f"query must leave one result: {postfix!r}")
    return stack[0]


# Terms one BIGINT of flags has room for.
WORD_BITS = 63


def _held(terms: list[str]) -> dict[str, Column]:
    """For each term the test of its flag in the columns m0, m1, …"""
    return {t: F.col(f"m{i // WORD_BITS}").bitwiseAND(F.lit(1 << i % WORD_BITS)) != 0
            for i, t in enumerate(terms)}


def _term_flags(index: DataFrame, terms: list[str]) -> DataFrame:
    """(docno, m0, m1, …): docnos holding any of the terms, with one flag bit per term.

    One filtered scan of the index and one aggregate, however many terms there are.
    """
    numbered = [(t, i // WORD_BITS, 1 << i % WORD_BITS) for i, t in enumerate(terms)]
    flags = index.sparkSession.createDataFrame(numbered, "term STRING, word INT, bit BIGINT")
    found = posting_rows(index.where(F.col("term").isin(terms))).join(flags, "term")
    words = [F.bit_or(F.when(F.col("word") == w, F.col("bit")).otherwise(0)).alias(f"m{w}")
             for w in range(-(-len(terms) // WORD_BITS))]
    return found.groupBy("docno").agg(*words)


def document_set(index: DataFrame, term: str) -> DataFrame:
    """(docno): the documents that contain the term."""
    return posting_rows(index.where(F.col("term") == term)).select("docno")


Fetch = Callable[[DataFrame], DataFrame]


def _with_text(found: DataFrame, lines: DataFrame | Fetch) -> DataFrame:
    """``found`` with the text of its docnos, from the lines or by a function that fetches
    (docno, text) of given docnos without reading every line."""
    texts = lines(found.select("docno").distinct()) if callable(lines) else lines
    return found.join(texts, "docno")


def boolean_retrieval(index: DataFrame, lines: DataFrame | Fetch, postfix: str) -> DataFrame:
    """(docno, text) of the lines that satisfy a postfix AND/OR query.

    A term the index lacks holds nowhere. Malformed queries raise ValueError.
    """
    return (boolean_retrieval_batch(index, lines, {0: postfix})
            .select("docno", "text"))


def boolean_retrieval_batch(index: DataFrame, lines: DataFrame | Fetch,
                            queries: dict[int, str]) -> DataFrame:
    """(qid, docno, text) for many postfix queries over one scan of the index."""
    terms = list(dict.fromkeys(t for q in queries.values() for t in query_terms(q)))
    held = _held(terms)
    hits = F.array_compact(F.array(*[F.when(_condition(q, held), F.lit(qid))
                                     for qid, q in queries.items()]))
    docs = _term_flags(index, terms)
    found = docs.select(F.explode(hits).alias("qid"), "docno")
    return _with_text(found, lines).select("qid", "docno", "text")


def lookup_postings(index: DataFrame, lines: DataFrame | Fetch, terms: list[str]) -> DataFrame:
    """(term, df, docno, tf, text): postings of the terms with the lines they point to."""
    found = posting_rows(index.where(F.col("term").isin(terms)))
    return _with_text(found, lines).select("term", "df", "docno", "tf", "text")


def absent_terms(index: DataFrame, terms: list[str]) -> DataFrame:
    """(term): the given terms that do not appear in the collection."""
    asked = index.sparkSession.createDataFrame([(t,) for t in dict.fromkeys(terms)], "term STRING")
    present = index.where(F.col("term").isin(terms)).select("term")
    return asked.join(present, "term", "left_anti")
