"""Document fingerprints by winnowing (Schleimer, Wilkerson, Aiken 2003).

Every ``k`` code points are hashed with a rolling sum; of each ``window`` successive
hashes the least is chosen, the rightmost of equal ones. Two texts that share any
passage of ``k + window - 1`` code points share a chosen hash, at the positions kept
beside it. A text shorter than ``k`` is one gram; a null or empty text has no
fingerprint. Likeness is the Jaccard index of the chosen hashes: 1 for two empty
fingerprints, 0 for an empty and another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from corvane.llm.common import map_rows
from corvane.plans.scratch import materialize

K = 32        # a power of two: the rolling sum is doubled
WINDOW = 32
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def winnow(text: str | None, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) chosen in ``text``, in order of position."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    grams = (codes.astype(np.uint64) + np.uint64(1)) * MIX
    grams ^= grams >> np.uint64(29)
    power, span = BASE, 1
    # Sums over 2, 4, .. k code points; a text shorter than k is summed as a whole.
    if n < k:
        with np.errstate(over="ignore"):
            powers = np.multiply.accumulate(np.full(n, BASE, np.uint64))[::-1]
            grams = np.array([(grams * powers).sum(dtype=np.uint64) + np.uint64(n)])
    else:
        with np.errstate(over="ignore"):
            while span < k:
                grams = grams[:-span] * power + grams[span:]
                power, span = power * power, 2 * span
    grams *= MIX
    grams ^= grams >> np.uint64(32)
    # High half: the hash. Low half: falls with the position, so ties go to the right.
    last = np.uint64(0xFFFFFFFF)
    least = (grams << np.uint64(32)) | (last - np.arange(len(grams), dtype=np.uint64))
    width, span = min(window, len(least)), 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:span - width], least[width - span:])
    chosen = least[np.concatenate(([True], least[1:] != least[:-1]))]
    return ((chosen >> np.uint64(32)).astype(np.uint32),
            (last - (chosen & last)).astype(np.int64))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard index of two sets of hashes, given as sorted distinct arrays."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def digest(hashes: np.ndarray, positions: np.ndarray) -> str:
    """32 hexadecimal digits that stand for the hashes and their positions."""
    if not len(hashes):
        return ""
    return hashlib.blake2b(hashes.tobytes() + positions.tobytes(), digest_size=16).hexdigest()


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``hashes`` and ``positions`` of the chosen grams."""
    rest = [c for c in docs.columns if c not in (text, "hashes", "positions")]
    frame = docs.select(*rest, F.col(text).alias("_text"))
    schema = docs.select(*rest, F.array(F.lit(0).cast("bigint")).alias("hashes"),
                         F.array(F.lit(0).cast("bigint")).alias("positions")).schema

    def rows(part: dict[str, list]) -> Iterator[tuple]:
        for *row, body in zip(*part.values()):
            hashes, positions = winnow(body, k, window)
            yield (*row, hashes.astype(np.int64), positions)

    return map_rows(frame, schema, rows)


def _edit(text: str, following: str) -> str:
    """The last quarter replaced by the first code points of the following text."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


_RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _compared(text: str, following: str, own: tuple, other: np.ndarray, k: int, window: int) -> tuple:
    """One result row of a text, its fingerprint and the set of the following text's."""
    edited = _edit(text, following)
    changed = winnow(edited, k, window)
    mine = np.unique(own[0])
    return (len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            digest(*own), digest(*changed), likeness(mine, np.unique(changed[0])),
            likeness(mine, other))


def edit_report(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of (doc_id, text) rows, of their edited texts, and how alike they are.

    The following document is the next by doc_id, after the last the first; rows that
    repeat a doc_id follow each other by their text, null ids come first and null texts
    are empty. One shuffle deals the texts out in ranges of doc_id; each task then
    walks its sorted rows with two texts at hand. The first and last text of each task
    travel with its result, and pairs across task borders are compared after that.
    """
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = whole.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    schema = f"doc_id long, {_RESULT}, part int, opens boolean, closes boolean, edge string"
    arrow = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()), ("part", pa.int32()),
        ("opens", pa.bool_()), ("closes", pa.bool_()), ("edge", pa.string())])
    nothing = (None,) * 6

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, ready, first = None, [], True
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                piece = batch.slice(start, 256)
                for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    own = winnow(text, k, window)
                    if held is not None:
                        at, before, prints = held
                        ready.append((at, *_compared(before, text, prints, np.unique(own[0]), k, window),
                                      part, first, False, before if first else None))
                        first = False
                    held = (doc_id, text, own)
                if ready:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*ready), arrow)], schema=arrow)
                    ready = []
        if held is not None:
            row = (held[0], *nothing, part, first, True, held[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], f.type) for c, f in zip(row, arrow)], schema=arrow)

    stored = materialize(ranged.mapInArrow(walk, schema), "fingerprints")
    edges = stored.where("opens OR closes")
    # One light row for each task's range: the border a range has with the next one.
    ranges = edges.where("opens").select("part")
    n_after = F.lead("part").over(Window.orderBy("part"))
    borders = ranges.select("part", n_after.alias("after"))
    least = ranges.agg(F.min("part").alias("least"))
    borders = (borders.join(F.broadcast(least))  # one row
               .select("part", F.coalesce("after", "least").alias("after")))
    last = edges.where("closes").select("part", "doc_id", F.col("edge").alias("text"))
    opening = edges.where("opens").select(F.col("part").alias("after"), F.col("edge").alias("following"))
    pairs = last.join(borders, "part").join(opening, "after").select("doc_id", "text", "following")

    def across(rows_in: dict[str, list]) -> Iterator[tuple]:
        for doc_id, text, following in zip(rows_in["doc_id"], rows_in["text"], rows_in["following"]):
            other = np.unique(winnow(following, k, window)[0])
            yield (doc_id, *_compared(text, following, winnow(text, k, window), other, k, window))

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]
    return (stored.where("NOT closes").select(names)
            .unionByName(map_rows(pairs, f"doc_id long, {_RESULT}", across, 16)))
