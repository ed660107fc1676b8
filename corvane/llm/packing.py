"""Packing of token ids into sequences: first-fit decreasing in randomised groups.

Documents are dealt evenly and at random over groups of about ``GROUP_BYTES`` of text, so
that every group sees the same mix of lengths; each group is packed on its own by one task.
A document is cut into whole sequences; what is left over is an item. Items go by falling
length, each into the first bin with room. A tournament tree over the bins' free places
finds that bin in logarithmic time: an inner node holds the greatest free place below it.

The last bins of a group are mostly empty. ``settle`` takes the least filled ones apart,
from the end, and cuts their items to fill the places other bins have left, as long as a
cut is at least ``LEAST_CUT`` ids long.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

SEQUENCE = 2048
END_ID = 1
GROUP_BYTES = 1 << 24
GROUP_IDS = 1 << 23   # a group is closed here, however dense its text is
LEAST_CUT = 16
OUT_PIECES = 1024     # pieces in one Arrow batch
# Sequence ids are the task's number in the upper and a count in the lower half.
TASK_SEQUENCES = 1 << 32

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")


@lru_cache(maxsize=4)
def encoder(ranks: str, pattern: str) -> Callable[[str], np.ndarray]:
    """Ids of a text under a rank file of a byte-level BPE; no string in it is special.

    The ids are those of the ``tokenizers`` file of the same vocabulary, at five times the
    speed; the tests hold both against each other.
    """
    with open(ranks, "rb") as file:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    coding = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
    return coding.encode_to_numpy


class Bins:
    """Bins of equal capacity under a tournament tree of their free places."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1
        while self.leaves < bins:
            self.leaves *= 2
        self.free = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """(bin, free places before) of the first bin that has room for ``length``."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < length:
                node += 1
        before = free[node]
        free[node] -= length
        found, node = node - self.leaves, node // 2
        while node:
            top = max(free[2 * node], free[2 * node + 1])
            if free[node] == top:
                break
            free[node] = top
            node //= 2
        return found, before


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items of each bin. Equal lengths go in the order given; no length exceeds ``capacity``."""
    bins, tree = [], Bins(len(lengths), capacity)
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at, _ = tree.place(lengths[item])
        if at == len(bins):
            bins.append([])
        bins[at].append(item)
    return bins


def settle(bins: list[list[tuple[int, int, int]]], capacity: int,
           least_cut: int = LEAST_CUT) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, start, length) after the emptiest were cut up into the others' room.

    Each step takes the least filled bin; it goes if all its ids fit into the places of
    ``least_cut`` or more that the others have left. What is left of it else stays.
    """
    held = sorted(bins, key=lambda b: -sum(piece[2] for piece in b))
    free = [capacity - sum(piece[2] for piece in b) for b in held]
    at = 0
    while held and at < len(held) - 1:
        if free[at] < least_cut:
            at += 1
            continue
        item, start, length = held[-1].pop()
        part = min(length, free[at])
        if part < length and length - part < least_cut:
            part = length - least_cut  # the rest must not become a crumb
        if part < least_cut and part < length:
            held[-1].append((item, start, length))
            at += 1
            continue
        held[at].append((item, start, part))
        free[at] -= part
        free[-1] += part
        if part < length:
            held[-1].append((item, start + part, length - part))
        elif not held[-1]:
            held.pop()
            free.pop()
    return held


def _packed(documents: list[tuple[int | None, np.ndarray]], capacity: int,
            least_cut: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) of one group."""
    rest = []
    for number, (_, ids) in enumerate(documents):
        whole = len(ids) // capacity * capacity
        for start in range(0, whole, capacity):
            yield [(number, start, capacity)]
        if whole < len(ids):
            rest.append((number, whole, len(ids) - whole))
    bins = first_fit_decreasing([piece[2] for piece in rest], capacity)
    yield from settle([[rest[i] for i in b] for b in bins], capacity, least_cut)


def pack(docs: DataFrame, ranks: str, pattern: str, *, capacity: int = SEQUENCE, end_id: int = END_ID,
         group_bytes: int = GROUP_BYTES, least_cut: int = LEAST_CUT) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): pieces of the documents.

    ``ranks`` and ``pattern`` name the tokenizer; ``ids`` are little-endian unsigned 32-bit
    numbers. Each document ends with ``end_id``; every id lies in one piece, and a sequence's
    pieces follow each other from 0 on. Whole texts are read, however long: a document of
    any length is cut into whole sequences first.

    A null or empty text is ``end_id`` alone. Null ids, repeated ids and repeated rows are
    documents of their own, one for each row. An empty table has no pieces. Only ``doc_id``
    and ``text`` are read; other columns, whatever their names, play no part. The result is
    the same whenever it is computed: groups come from an even deal that Spark repeats, and
    each is put in order before it is packed.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    dealt = rows.repartition(max(1, -(-size // group_bytes))).sortWithinPartitions(
        F.xxhash64("doc_id", "text"), "doc_id", "text")
    schema = pa.schema([(name, pa.binary() if kind == "binary" else pa.int64())
                        for name, kind in (part.split() for part in PIECES.split(", "))])

    def batches_of(documents: list[tuple[int | None, np.ndarray]], first: int) -> Iterator[tuple[list, int]]:
        """Lists of output rows and the number of sequences up to there."""
        out, sequence = [], first
        for pieces in _packed(documents, capacity, least_cut):
            offset = 0
            for number, start, length in pieces:
                doc_id, ids = documents[number]
                out.append((doc_id, start, length, ids[start:start + length].tobytes(), len(ids),
                            sequence, offset))
                offset += length
            sequence += 1
            if len(out) >= OUT_PIECES:
                yield out, sequence
                out = []
        yield out, sequence

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(ranks, pattern), np.array([end_id], "<u4")
        sequence = TaskContext.get().partitionId() * TASK_SEQUENCES
        documents, held = [], 0

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            for out, sequence in batches_of(documents, sequence):
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(column, f.type) for column, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = np.concatenate((encode(text.as_py()).astype("<u4", copy=False), end))
                documents.append((doc_id.as_py(), ids))
                held += len(ids)
                if held >= GROUP_IDS:
                    yield from emit()
                    documents, held = [], 0
        yield from emit()

    return dealt.mapInArrow(run, PIECES)


def padded_length(used: Column, capacity: int = SEQUENCE) -> Column:
    """A sequence's length on disk: ``capacity``, or ``used`` itself at a power of two."""
    return F.when(F.bit_count(used) == 1, used).otherwise(F.lit(capacity)).cast("bigint")


def sequences(pieces: DataFrame, capacity: int = SEQUENCE, pad_id: int = 0) -> DataFrame:
    """(sequence_id, used, ids): the sequences with their padding, as files for training hold them.

    A sequence has at most ``capacity`` pieces, so its list is bounded.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    pad = F.lit(int(pad_id).to_bytes(4, "little"))
    joined = pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"), parts.alias("parts"))
    body = F.aggregate("parts", F.lit(b""), lambda body, part: F.concat(body, part["ids"]))
    filled = F.expr(f"4 * CAST(IF(bit_count(used) = 1, used, {int(capacity)}) AS INT)")
    return joined.select("sequence_id", "used", F.rpad(body, filled, pad).alias("ids"))
