"""Co-occurrence counts and pointwise mutual information of terms within lines."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from corvane.functions.measures import pmi as pmi_of
from corvane.functions.tokens import distinct_tokens
from corvane.operators.words import document_frequency
from corvane.plans.ids import dense_ids
from corvane.plans.scratch import materialize, release, sweep
from corvane.plans.skew import TASK_ROWS, hot_keys, skew_join, spread_rows


# Partners of a term that one row of its stripe may hold.
STRIPE_ENTRIES = 65_536
# Terms of a line that one task pairs with the rest of the line.
LINE_TERMS = 4_096
# Lists of partners take many times the room of the lines. They are shuffled in rounds of so
# many partners for each term of a line, and terms are numbered in so many rounds, where there
# are more than the least: disk grows with the lines, and the number of rounds does not.
ROUND_PARTNERS = 2
TERM_ROUNDS = 4
LEAST_ROUND = 1 << 24


def _frequent_terms(lines: DataFrame, min_support: int) -> DataFrame:
    """(term, df, number): the terms in at least ``min_support`` lines, numbered 1..V."""
    kept = document_frequency(lines).where(F.col("df") >= min_support)
    return materialize(dense_ids(kept, [F.asc("term")], "number"), "terms")


def _owned(lists: DataFrame, line_terms: int) -> DataFrame:
    """(docno, x, ys): each term of a line with the terms after it.

    The terms of a line above ``line_terms`` are dealt out in parts first, so that one
    task doesn't form all lists of a long line.
    """
    long_line = F.size("terms") > line_terms
    parts = F.sequence(F.lit(0), F.floor((F.size("terms") - 1) / line_terms).cast("int"))
    dealt = (lists.where(long_line).select("docno", "terms", F.explode(parts).alias("part"))
             .repartition("docno", "part")
             .select("docno", F.posexplode(F.slice("terms", F.col("part") * line_terms + 1, F.lit(line_terms)))
                     .alias("at", "x"), "terms", "part")
             .select("docno", (F.col("part") * line_terms + F.col("at")).alias("i"), "x", "terms"))
    whole = lists.where(~long_line).select("docno", F.posexplode_outer("terms").alias("i", "x"), "terms")
    partners = F.slice("terms", F.col("i") + 2, F.size("terms"))
    return (whole.unionByName(dealt).where(F.col("i") + 1 < F.size("terms"))
            .select("docno", "x", partners.alias("ys")))


def _line_terms(lines: DataFrame, terms: DataFrame, task_rows: int, least_round: int) -> list[DataFrame]:
    """(docno, terms), stored tables: the numbers of each line's terms, rarest first."""
    total, last = terms.agg(F.sum("df"), F.max("number")).first()
    rounds = TERM_ROUNDS if (total or 0) > least_round else 1
    kind = "int" if (last or 0) < 1 << 31 else "bigint"
    rising = F.sort_array(F.collect_list(F.struct("df", "number")))["number"].cast(f"array<{kind}>")
    lists = []
    for at in range(rounds):
        part = lines if rounds == 1 else lines.where(F.pmod(F.xxhash64("docno"), F.lit(rounds)) == at)
        found = part.select("docno", F.explode_outer(distinct_tokens("text")).alias("term"))
        kept = skew_join(found, terms, ["term"], terms, weight="df", by=["docno"], task_rows=task_rows)
        lists.append(materialize(kept.groupBy("docno").agg(rising.alias("terms")), "line_terms"))
        if rounds > 1:
            sweep(lines.sparkSession)
    return lists


def _counted_pairs(lines: DataFrame, terms: DataFrame, min_support: int, task_rows: int,
                   line_terms: int = LINE_TERMS, *, least_round: int = LEAST_ROUND) -> DataFrame:
    """(a, x, df_a, b, y, df_b, n): unordered pairs of terms found in n >= min_support lines,
    with the terms' numbers.

    A pair cannot be in more lines than either of its terms, so rare terms are
    dropped from the lines before any pair is formed; no pair that counts is lost.
    Terms travel as numbers, and a term is shuffled once per line with the list of
    its partners there instead of once per pair. The rarer term of a pair owns it:
    the commoner a term, the fewer partners follow it in a line.
    """
    # Stored once: the text is cut into terms and joined to their numbers a single time.
    parts = _line_terms(lines, terms, task_rows, least_round)
    lists = reduce(DataFrame.unionByName, parts)
    after = F.transform("terms", lambda x, i: F.struct(x.alias("x"), (F.size("terms") - i - 1).alias("n")))
    entries = materialize(lists.select(F.inline(after)).groupBy("x").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("lines")),
                          "owners")
    hot = hot_keys(entries, ["x"], task_rows=task_rows)
    partners, held = entries.agg(F.sum("n"), F.sum("lines")).first()
    rounds = max(1, ceil((partners or 0) / max(least_round, ROUND_PARTNERS * (held or 0))))
    found = []
    for at in range(rounds):
        owned = _owned(lists, line_terms)
        if rounds > 1:
            owned = owned.where(F.pmod(F.xxhash64("x"), F.lit(rounds)) == at)
        # The exchange on the owner serves the count as well; only an owner whose partners
        # fill more than a task is counted in parts first.
        if hot is None:
            counted = (owned.repartition("x").select("x", F.explode_outer("ys").alias("y"))
                       .groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")))
        else:
            counted = (spread_rows(owned, ["x"], ["docno"], hot).repartition("x", "salt")
                       .select("x", "salt", F.explode_outer("ys").alias("y"))
                       .groupBy("x", "salt", "y").agg(F.count(F.lit(1)).alias("n"))
                       .groupBy("x", "y").agg(F.sum("n").alias("n")))
        numbers = [F.col(c).cast("bigint").alias(c) for c in ("x", "y")]
        found.append(materialize(counted.where(F.col("n") >= min_support).select(*numbers, "n"), "pairs"))
        if rounds > 1:
            sweep(lines.sparkSession)
    release(*parts, entries)
    pairs = reduce(DataFrame.unionByName, found)
    return _with_terms(pairs, terms, task_rows)


def _with_terms(pairs: DataFrame, terms: DataFrame, task_rows: int) -> DataFrame:
    """Add the terms of counted pairs, stored, and their frequencies to the numbers."""
    first = terms.select(F.col("number").alias("x"), F.col("term").alias("a"), F.col("df").alias("df_a"))
    second = terms.select(F.col("number").alias("y"), F.col("term").alias("b"), F.col("df").alias("df_b"))
    per_x, per_y = (pairs.groupBy(c).agg(F.count(F.lit(1)).alias("n")) for c in ("x", "y"))
    half = skew_join(pairs, first, ["x"], per_x, by=["y"], task_rows=task_rows)
    return skew_join(half, second, ["y"], per_y, by=["x"], task_rows=task_rows)


def _both_orders(pairs: DataFrame, *carried: str) -> DataFrame:
    """Each unordered pair once as (a, b) and once as (b, a), with the number of the second."""
    turns = F.array(F.struct(F.col("a"), F.col("b"), F.col("y").alias("number")),
                    F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("x").alias("number")))
    return (pairs.select(F.explode(turns).alias("turn"), *carried)
            .select("turn.a", "turn.b", "turn.number", *carried))


def cooccurrence_pairs(lines: DataFrame, min_support: int = 10, *,
                       task_rows: int = TASK_ROWS) -> DataFrame:
    """(a, b, n): number of lines that hold both terms, in both orders."""
    terms = _frequent_terms(lines, min_support)
    return _both_orders(_counted_pairs(lines, terms, min_support, task_rows), "n").drop("number")


def cooccurrence_stripes(lines: DataFrame, min_support: int = 10,
                         entries: int = STRIPE_ENTRIES, *,
                         task_rows: int = TASK_ROWS) -> DataFrame:
    """(a, block, stripe MAP<b, n>): the partners of each term.

    A block holds the partners whose numbers, 1..V in byte order, fall in one run of
    ``entries``, so a row never has more than that.
    """
    terms = _frequent_terms(lines, min_support)
    pairs = _both_orders(_counted_pairs(lines, terms, min_support, task_rows), "n")
    partners = F.sort_array(F.collect_list(F.struct("b", "n")))
    return (pairs.groupBy("a", F.expr(f"(number - 1) div {entries}L").alias("block"))
            .agg(F.map_from_entries(partners).alias("stripe")))


def stripe_rows(stripes: DataFrame) -> DataFrame:
    """(a, b, n) rows of the stripes."""
    return stripes.select("a", F.explode("stripe").alias("b", "n"))


def pmi(lines: DataFrame, min_support: int = 10, n_docs: int | None = None, *,
        task_rows: int = TASK_ROWS) -> DataFrame:
    """(a, b, n, pmi): natural-log PMI of the pairs in at least ``min_support`` lines.

    ``n_docs`` defaults to the number of lines, empty ones included.
    """
    terms = _frequent_terms(lines, min_support)
    pairs = _counted_pairs(lines, terms, min_support, task_rows)
    total: Column = (lines.agg(F.count(F.lit(1))).scalar() if n_docs is None
                     else F.lit(n_docs))
    scored = pairs.withColumn("pmi", pmi_of(total, "n", "df_a", "df_b"))
    return _both_orders(scored, "n", "pmi").drop("number")


def max_pmi_pair(scored: DataFrame) -> DataFrame:
    """(a, b, pmi): the pair of highest PMI, ties to the least (a, b)."""
    return scored.orderBy(F.desc("pmi"), "a", "b").limit(1).select("a", "b", "pmi")


def top_pmi_for_word(scored: DataFrame, words: list[str], k: int = 3) -> DataFrame:
    """(a, rank, b, pmi): the k best partners of each given word."""
    best = Window.partitionBy("a").orderBy(F.desc("pmi"), "b")
    return (scored.where(F.col("a").isin(words))
            .withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k)
            .select("a", "rank", "b", "pmi"))
