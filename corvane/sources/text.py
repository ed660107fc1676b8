"""Readers of text collections and tab-separated files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corvane.functions.tokens import SPACE_DELIMITERS


def read_text(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """(text): one row per line of plain or ``.gz`` files or directories of them.

    A gzip file is one split whatever its size; ``partitions`` spreads its lines.
    """
    lines = spark.read.text(path).withColumnRenamed("value", "text")
    return lines if partitions is None else lines.repartition(partitions)


_PLACED = "file string, block long, at long, text string"


def _runs(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    """(start, stop) of the runs of rows of one split."""
    changes = np.zeros(batch.num_rows, bool)
    for name in ("file", "block"):
        column = batch.column(name)
        changes[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    cuts = [0, *np.flatnonzero(changes).tolist(), batch.num_rows]
    return [run for run in zip(cuts, cuts[1:]) if run[0] < run[1]]


def _cut_lines(values: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The lines of values that hold a CR, the value each comes from, and its offset there."""
    out, of, at = [], [], []
    for i, value in enumerate(values.to_pylist()):
        # The CR of a final CR LF ends the same line as the LF.
        pieces, place = value.split(b"\r"), 0
        for piece in pieces[:-1] if len(pieces) > 1 and not pieces[-1] else pieces:
            out.append(piece)
            of.append(i)
            at.append(place)
            place += len(piece) + 1
    return pa.array(out, pa.large_binary()), np.array(of, np.int64), np.array(at, np.int64)


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their byte offset in their split, cut at a lone CR as well.

    A task reads a split's rows in order, so a running sum of their lengths is all it
    takes; rows are looked at one by one only where they hold a CR.
    """
    running, split = 0, None
    for batch in batches:
        for start, stop in _runs(batch):
            part = batch.slice(start, stop - start)
            place = (part.column("file")[0].as_py(), part.column("block")[0].as_py())
            if place != split:
                running, split = 0, place
            lines = part.column("value").cast(pa.large_binary())
            ends = running + np.cumsum(pc.binary_length(lines).to_numpy(zero_copy_only=False) + 1)
            at, running = np.concatenate(([running], ends[:-1])), int(ends[-1])
            broken = pc.match_substring(lines, b"\r").to_numpy(zero_copy_only=False)
            if broken.any():
                cut, of, inside = _cut_lines(lines.filter(pa.array(broken)))
                whole = np.flatnonzero(~broken)
                at = np.concatenate((at[whole], at[np.flatnonzero(broken)][of] + inside))
                lines = pa.concat_arrays([lines.take(pa.array(whole)), cut])
            rows = len(lines)
            yield pa.RecordBatch.from_arrays(
                [pa.array([place[0]] * rows, pa.string()), pa.array(np.full(rows, place[1], np.int64)),
                 pa.array(at.astype(np.int64)), lines.cast(pa.binary()).view(pa.string())],
                names=["file", "block", "at", "text"])


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(docno, text): the lines of a collection with their byte offset as docno.

    A line ends at LF, CR LF or CR. Several files count as one text in path order. The
    text is not shuffled: offsets run inside a split, and the splits' starts, one light
    row each, are sums of the splits' lengths.
    """
    # Cut at line feeds only, so that every row is exactly one byte longer than its value.
    raw = (spark.read.option("lineSep", "\n").text(path)
           .select("value", F.col("_metadata.file_path").alias("file"),
                   F.col("_metadata.file_block_start").alias("block")))
    over_splits = Window.orderBy("file", "block")
    starts = (raw.groupBy("file", "block").agg(F.sum(F.octet_length("value") + 1).alias("bytes"))
              .select("file", "block", (F.sum("bytes").over(over_splits) - F.col("bytes"))
                      .alias("start")))
    return (raw.mapInArrow(_placed, _PLACED)
            .join(F.broadcast(starts), ["file", "block"])  # one row for each split
            .select((F.col("start") + F.col("at")).alias("docno"), "text"))


def _fields(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(f): tab-separated fields of each line; empty ones at the end do not count."""
    return spark.read.text(path).select(F.split(F.rtrim("value", F.lit("\t")), "\t").alias("f"))


def read_observations(spark: SparkSession, path: str | list[str], type_name: str = "int") -> DataFrame:
    """(k, v): rows of exactly two tab-separated fields; others are skipped.

    A value that is not a number fails the job.
    """
    return (_fields(spark, path).where(F.size("f") == 2)
            .select(F.get("f", F.lit(0)).alias("k"), F.get("f", F.lit(1)).cast(type_name).alias("v")))


def read_scored_pairs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(a, b, pmi): lines ``(a, b)<TAB>number`` as the PMI writer leaves them."""
    rows = read_observations(spark, path, "double")
    # A term holds any character but the space among the delimiters.
    pattern = r"^\(([^ ]+), ([^ ]+)\)\z"
    key = F.when(F.col("k").rlike(pattern), F.col("k")).otherwise(
        F.raise_error(F.concat(F.lit("not a pair of terms: "), F.col("k"))))
    return rows.select(F.regexp_extract(key, pattern, 1).alias("a"),
                       F.regexp_extract(key, pattern, 2).alias("b"), F.col("v").alias("pmi"))


def read_adjacency(spark: SparkSession, path: str | list[str],
                   tabs: bool = False) -> tuple[DataFrame, DataFrame]:
    """(nodes(id), edges(src, dst)) of lines ``node n1 n2 …``.

    Fields are cut at any white space, or at single tabs with ``tabs``. A line
    with the node alone is a node without out-links.
    """
    pattern: str = "\t" if tabs else SPACE_DELIMITERS
    # Java's trim: control characters count as white space too.
    line: Column = F.regexp_replace("value", "^[\\x00-\\x20]+|[\\x00-\\x20]+$", "")
    lists = (spark.read.text(path).select(F.split(line, pattern).alias("f"))
             .where(F.get("f", F.lit(0)) != "")
             .select(F.get("f", F.lit(0)).cast("bigint").alias("id"), "f"))
    named = F.slice("f", 2, F.size("f"))
    edges = (lists.select(F.col("id").alias("src"), F.explode(named).alias("dst"))
             .select("src", F.col("dst").cast("bigint").alias("dst")))
    return lists.select("id"), edges


def read_log(spark: SparkSession, path: str | list[str], require_content: bool = True) -> DataFrame:
    """(id, date, user, content): tab-separated records of four or more fields.

    With ``require_content`` a record whose fields from the fourth on are all
    empty is dropped.
    """
    rows = _fields(spark, path)
    if require_content:
        rows = rows.where(F.size("f") >= 4)
    names = ["id", "date", "user", "content"]
    return rows.select(*[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_tsv(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Typed tab-separated records with a declared schema; quotes are plain characters.

    A field that doesn't parse as its type becomes null and isn't reported, as in Pig.
    """
    return (spark.read.schema(schema).option("sep", "\t").option("quote", "")
            .option("mode", "PERMISSIVE").csv(path))
