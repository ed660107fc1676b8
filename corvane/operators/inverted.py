"""Inverted index: building, gap coding and histograms.

An index is ``(term, df, shard, postings ARRAY<docno, tf>)``. A shard is a range
of ``span`` docnos, so a posting list is cut where the collection is cut and the
term found in every line is spread over as many rows as there are shards. ``df``
is the term's number of documents in the whole collection; postings ascend by docno.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from corvane.functions.measures import block_of
from corvane.operators.words import term_frequency
from corvane.plans.scratch import materialize, sweep
from corvane.plans.skew import TASK_ROWS, skew_join

# Docnos of one shard: a posting row has at most that many entries, whatever docnos are.
SPAN = 1 << 20
NO_SHARD = -(1 << 63)


def build_inverted_index(lines: DataFrame, span: int = SPAN, *,
                         task_rows: int = TASK_ROWS) -> DataFrame:
    """(term, df, shard, postings) of the collection.

    The text is read once: lists are grouped by term and shard and stored, and ``df`` is
    the sum of their sizes, joined back over one light row per list. Lists stay in the
    buckets of term and shard they were grouped in; only light rows are moved to them.
    """
    # A line without a number has no shard; its lists are joined under a number no shard has.
    shard = F.coalesce(block_of("docno", span), F.lit(NO_SHARD).cast("bigint"))
    entries = term_frequency(lines).withColumn("block", shard)
    lists = materialize(
        entries.groupBy("term", "block")
        .agg(F.sort_array(F.collect_list(F.struct("docno", "tf"))).alias("postings")), "lists",
        keyed_by=["term", "block"], dealt=True)
    sweep(lines.sparkSession)
    light = lists.select("term", "block", F.size("postings").alias("own"))
    sizes = light.groupBy("term").agg(F.sum("own").alias("df"), F.count(F.lit(1)).alias("n"))
    sizes = materialize(sizes, "dictionary")
    each = skew_join(light.select("term", "block"), sizes.select("term", "df"), ["term"], sizes, by=["block"],
                     task_rows=task_rows)
    index = (lists.join(each.hint("shuffle_hash"), ["term", "block"])
             .select("term", "df", F.nullif("block", F.lit(NO_SHARD)).alias("shard"), "postings"))
    index.stored = [lists, sizes]
    return index


def store_index(index: DataFrame, name: str = "index", replaces: Sequence[DataFrame] = ()) -> DataFrame:
    """The index in stored buckets of term and shard, which gap coding reads as they lie.

    The tables it was built from and those in ``replaces`` are deleted.
    """
    stored = materialize(index, name, replaces=[*getattr(index, "stored", []), *replaces],
                         keyed_by=["term", "shard"], dealt=True)
    sweep(index.sparkSession)
    return stored


def posting_rows(index: DataFrame) -> DataFrame:
    """(term, df, docno, tf) rows of the index."""
    return index.select("term", "df", F.inline("postings"))


def tf_histogram(index: DataFrame, terms: list[str] | None = None) -> DataFrame:
    """(term, tf, n): how many documents have each tf, for the given or all terms."""
    if terms is not None:
        index = index.where(F.col("term").isin(terms))
    return (posting_rows(index).groupBy("term", "tf").agg(F.count(F.lit(1)).alias("n")))


def _with_carry(lists: DataFrame, per_shard: Column, carry: Column) -> DataFrame:
    """Add ``carry``, computed over one light row per (term, shard), to the lists.

    The lists are read twice: pass a stored index.
    """
    light = lists.select("term", "shard", per_shard.alias("own")).select("term", "shard",
                                                                        carry.alias("carry"))
    # Light rows are looked up by a hash, so that lists aren't sorted, nor moved where they
    # lie in buckets of term and shard.
    return lists.join(light.hint("shuffle_hash"), ["term", "shard"])


def _gap_lists(index: DataFrame) -> DataFrame:
    """The index with ``gaps ARRAY<docno, gap, tf>`` in place of its postings."""
    before = F.lag("own", 1, 0).over(Window.partitionBy("term").orderBy("shard"))
    lists = _with_carry(index, F.element_at("postings", -1)["docno"], before)

    def gap(p: Column, i: Column) -> Column:
        last = F.when(i == 0, F.col("carry")).otherwise(F.get("postings", i - 1)["docno"])
        return F.struct(p["docno"].alias("docno"), (p["docno"] - last).alias("gap"),
                        p["tf"].alias("tf"))

    return lists.select("term", "df", "shard", F.transform("postings", gap).alias("gaps"))


def posting_gaps(index: DataFrame) -> DataFrame:
    """(term, docno, gap, tf): each posting with its distance to the one before it.

    The first gap of a term is its first docno; the first gap of a later shard
    continues from the last docno of the term's shard before.
    """
    # The outer form infers no filter on the list, which would compute it twice.
    return _gap_lists(index).select("term", F.inline_outer("gaps"))


def compress_postings(index: DataFrame) -> DataFrame:
    """(term, df, shard, gaps ARRAY<gap, tf>): the index with gaps for docnos."""
    gaps = F.transform("gaps", lambda g: F.struct(g["gap"].alias("gap"), g["tf"].alias("tf")))
    return _gap_lists(index).withColumn("gaps", gaps)


def restore_docnos(compressed: DataFrame) -> DataFrame:
    """(term, docno, tf) from the gaps alone, by prefix sums within and over shards."""
    in_term = Window.partitionBy("term").orderBy("shard")
    in_shard = Window.partitionBy("term", "shard").orderBy("pos")
    total = F.aggregate("gaps", F.lit(0).cast("bigint"), lambda acc, g: acc + g["gap"])
    lists = _with_carry(compressed, total, F.sum("own").over(in_term) - F.col("own"))
    return (lists.select("term", "shard", "carry", F.posexplode_outer("gaps").alias("pos", "g"))
            .select("term", (F.col("carry") + F.sum("g.gap").over(in_shard)).alias("docno"), "g.tf"))


_RUNS = "term string, first long, postings array<struct<docno:bigint,tf:bigint>>"


def _cut_runs(span: int):
    """A function that cuts sorted (term, docno, tf) batches into runs of one term.

    Lists are built from the batches' columns as they are: no row becomes an object.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            term, docno, tf = batch.column(0), batch.column(1), batch.column(2)
            shard = np.floor_divide(docno.to_numpy(), span)
            other = pc.not_equal(term.slice(1), term.slice(0, rows - 1)).to_numpy(zero_copy_only=False)
            starts = np.concatenate(([0], np.flatnonzero(other | (shard[1:] != shard[:-1])) + 1))
            offsets = np.append(starts, rows).astype(np.int32)
            entries = pa.StructArray.from_arrays([docno, tf], names=["docno", "tf"])
            yield pa.RecordBatch.from_arrays(
                [term.take(pa.array(starts)), docno.take(pa.array(starts)),
                 pa.ListArray.from_arrays(pa.array(offsets), entries)], names=["term", "first", "postings"])

    return cut


def sorted_runs(lines: DataFrame, span: int = SPAN) -> DataFrame:
    """(term, first, postings): posting lists from one sort on term and docno.

    Postings are range-partitioned and sorted by (term, docno); lists are cut from the
    sorted stream where the term changes, at a multiple of ``span`` docnos, and at the
    border of a batch or task, so no list is collected and a term found everywhere is
    spread over tasks like any other. ``first`` is a run's least docno: runs in order of
    (term, first) are the index, and one exchange makes it.
    """
    entries = term_frequency(lines).select("term", "docno", F.col("tf").cast("bigint").alias("tf"))
    ordered = entries.repartitionByRange("term", "docno").sortWithinPartitions("term", "docno")
    return ordered.mapInArrow(_cut_runs(span), _RUNS)
