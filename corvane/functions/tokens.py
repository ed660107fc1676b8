"""Token expressions over text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The delimiter sets of the two tokenizers and the alphabetic test.
WORD_DELIMITERS = "[ \\t\\n\\r\\f]+"
SPACE_DELIMITERS = "\\s+"
ALPHABETIC = "^[A-Za-z]+\\z"


def tokens(text: Column | str, delimiters: str = WORD_DELIMITERS) -> Column:
    """Tokens of a text in order, without empty ones and without case folding."""
    return F.array_remove(F.split(text, delimiters), "")


def distinct_tokens(text: Column | str, delimiters: str = WORD_DELIMITERS) -> Column:
    """Each token once, in first-seen order."""
    return F.array_distinct(tokens(text, delimiters))


def is_alphabetic(token: str) -> Column:
    return F.col(token).rlike(ALPHABETIC)


def token_runs(lines: DataFrame, delimiters: str) -> DataFrame:
    """(term, docno, tf): run lengths of the sorted tokens of each line.

    Each array that is used twice is a projection of its own, and none is the bare
    input of the generator: Spark would infer a filter on it and evaluate it again.
    """
    words = lines.select("docno", F.sort_array(tokens("text", delimiters)).alias("words"))
    starts = F.array_compact(F.transform("words", lambda w, i: F.when(
        (i == 0) | (w != F.get("words", i - 1)), i)))
    places = words.select("docno", "words", starts.alias("starts"))
    end = lambda j: F.coalesce(F.get("starts", j + 1), F.size("words"))
    runs = F.transform("starts", lambda p, j: F.struct(
        F.get("words", p).alias("term"), (end(j) - p).cast("bigint").alias("tf")))
    return (places.select("docno", F.explode(runs).alias("run"))
            .select("run.term", "docno", "run.tf"))
