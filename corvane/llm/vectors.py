"""Compression of vectors by product quantization with adaptive distance bounds.

Vectors of whole numbers are cut into equal parts; each part position has a codebook of
``ENTRIES`` entries, moved by rounds of assignment and averaging. An assignment needs no
distances to most entries: every part keeps its ``b`` closest entries with lower bounds of
their distances in rising order, and one outer bound for all the others. When entries move,
bounds fall by the way their entries went (the outer one by the longest way). A part
whose distance to its own entry is below all bounds is settled; else the entries whose
bounds don't exclude them are compared by whole-number squared distances, and all entries
where the outer bound fails. Bounds are 16-bit floats rounded down, so they never exclude
a nearest entry, and ties go to the lower index.

``b`` adapts: after each assignment it becomes the number of entries that nine parts in
ten needed, within ``LEAST_KEPT`` and an eighth of the entries.

State between rounds is a stored table: vector, code and bounds. The driver holds
codebooks only, ``PARTS * ENTRIES`` entries at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corvane.plans.scratch import materialize

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
LEAST_KEPT = 2
SLICE = 512          # vectors compared at a time
MARGIN = 1e-6        # relative error allowed for square roots

STATE = "vec_id long, label int, vector array<int>, code binary, near binary, lower binary, outer binary, error long"


def whole_vectors(table: DataFrame, parts: int = PARTS) -> DataFrame:
    """(vec_id, label, vector): components as ``floor(SCALE * x)``, rows without use dropped.

    Dropped are null vectors, vectors with null or non-finite components, and those that
    can't be coded: of a length that isn't a positive multiple of ``parts``, or with a
    component so large that squared distances, summed over the vector, wouldn't fit a long.
    """
    size = F.size("embedding")
    bound = F.floor(F.sqrt(F.lit(float(1 << 63)) / size) / 2) - 2
    usable = F.forall("scaled", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) <= F.col("bound")), F.lit(False)))
    scaled = (table.where((size > 0) & (size % parts == 0))
              .select("vec_id", F.col("label").cast("int").alias("label"), bound.alias("bound"),
                      F.transform("embedding", lambda x: x.cast("double") * SCALE).alias("scaled")))
    return scaled.where(usable).select(
        "vec_id", "label", F.transform("scaled", lambda x: F.floor(x).cast("int")).alias("vector"))


def _down(values: np.ndarray) -> np.ndarray:
    """Values as 16-bit floats, none above its value."""
    clipped = np.minimum(values, 65504.0)
    small = clipped.astype(np.float16)
    return np.where(small.astype(np.float64) > clipped, np.nextafter(small, np.float16(-np.inf)), small)


def _squares(vectors: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances (rows, parts, entries), in whole numbers."""
    out = np.empty((len(vectors), book.shape[0], book.shape[1]), np.int64)
    for part in range(book.shape[0]):
        gap = vectors[:, part, None, :] - book[part][None, :, :]
        out[:, part] = np.einsum("nkw,nkw->nk", gap, gap)
    return out


def nearest(vectors: np.ndarray, book: np.ndarray, kept: int) -> tuple[np.ndarray, ...]:
    """(code, error, near, lower, outer) from distances to every entry.

    Vectors are (rows, parts, width), the book (parts, entries, width), both int64.
    ``near`` are the ``kept`` closest entries beside the own one.
    """
    squares = _squares(vectors, book)
    order = np.argsort(squares, axis=2, kind="stable")
    code = order[:, :, 0]
    error = np.take_along_axis(squares, code[:, :, None], 2)[:, :, 0]
    near = order[:, :, 1:kept + 1]
    lower = _down(np.sqrt(np.take_along_axis(squares, near, 2).astype(np.float64)) * (1 - MARGIN))
    if order.shape[2] > kept + 1:
        rest = np.take_along_axis(squares, order[:, :, kept + 1:kept + 2], 2)[:, :, 0]
        outer = _down(np.sqrt(rest.astype(np.float64)) * (1 - MARGIN))
    else:
        outer = np.full(code.shape, np.float16(65504.0))
    return code, error, near, lower, outer


def reassign(vectors: np.ndarray, book: np.ndarray, drift: np.ndarray, code: np.ndarray, near: np.ndarray,
             lower: np.ndarray, outer: np.ndarray, kept: int) -> tuple[np.ndarray, ...]:
    """The result of :func:`nearest` for a moved book, from the bounds for the book before,
    and how many entries beside its own each part needed (all of them: the outer bound failed).

    ``drift`` is how far each entry went. Bounds that hold stay (lowered); only parts with
    uncertain bounds are compared again, in whole numbers.
    """
    parts, entries = book.shape[:2]
    gap = vectors - book[np.arange(parts)[None, :], code]
    error = np.einsum("npw,npw->np", gap, gap)
    upper = np.sqrt(error.astype(np.float64)) * (1 + MARGIN)
    part = np.arange(parts)[None, :, None]
    moved = lower.astype(np.float64) - drift[part, near]
    # The outer bound holds for entries that aren't kept; the longest way of all bounds theirs.
    beyond = outer.astype(np.float64) - drift.max(axis=1)[None, :]
    if entries <= near.shape[2] + 1:
        beyond = np.full(code.shape, 65504.0)
    open_entries = (moved <= upper[:, :, None]).sum(axis=2)
    needed = np.where(beyond <= upper, entries - 1, open_entries)
    code, near = code.copy(), near.copy()
    moved, beyond = _down(np.maximum(moved, 0)), _down(np.maximum(beyond, 0))
    lost = beyond.astype(np.float64) <= upper
    at, of = np.nonzero((needed > 0) & (needed < entries - 1) & ~lost)
    if len(at):  # some kept entries may be nearer, no others
        some = np.concatenate((code[at, of, None], near[at, of]), axis=1)
        gap = vectors[at, of][:, None, :] - book[of[:, None], some]
        squares = np.einsum("nkw,nkw->nk", gap, gap)
        order = np.lexsort((some, squares), axis=1)
        some, squares = np.take_along_axis(some, order, 1), np.take_along_axis(squares, order, 1)
        code[at, of], error[at, of], near[at, of] = some[:, 0], squares[:, 0], some[:, 1:]
        moved[at, of] = _down(np.sqrt(squares[:, 1:].astype(np.float64)) * (1 - MARGIN))
    keep = min(kept, near.shape[2])
    if keep < near.shape[2]:  # b falls: the entries let go join the outer bound
        order = np.argsort(moved, axis=2, kind="stable")
        near, moved = np.take_along_axis(near, order, 2), np.take_along_axis(moved, order, 2)
        beyond = np.minimum(beyond, moved[:, :, keep])
        near, moved = near[:, :, :keep], moved[:, :, :keep]
    at, of = np.nonzero(lost | (needed >= entries - 1))
    if len(at):  # all entries, in whole numbers
        gap = vectors[at, of][:, None, :] - book[of]
        squares = np.einsum("nkw,nkw->nk", gap, gap)
        order = np.argsort(squares, axis=1, kind="stable")
        ranked = np.take_along_axis(squares, order, 1)
        code[at, of], error[at, of] = order[:, 0], ranked[:, 0]
        near[at, of] = order[:, 1:keep + 1]
        roots = _down(np.sqrt(ranked.astype(np.float64)) * (1 - MARGIN))
        moved[at, of] = roots[:, 1:keep + 1]
        beyond[at, of] = roots[:, keep + 1] if entries > keep + 1 else np.float16(65504.0)
    return code, error, near, moved, beyond, needed


def _matrix(column: pa.Array) -> np.ndarray:
    """A binary column of equal lengths as one row of bytes each."""
    joined = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return joined.reshape(len(column), len(joined) // len(column))


def _vectors(column: pa.ListArray, parts: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), parts, -1)


def _state(part: pa.RecordBatch, found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    code, error, near, lower, outer = found[:5]

    def packed(values: np.ndarray, kind) -> pa.Array:
        return pa.array([row.tobytes() for row in np.ascontiguousarray(values.astype(kind))], pa.binary())

    return pa.RecordBatch.from_arrays(
        [part.column("vec_id"), part.column("label"), part.column("vector"), packed(code, np.uint8),
         packed(near, np.uint8), packed(lower, np.float16), packed(outer, np.float16),
         pa.array(error.sum(axis=1), pa.int64())],
        names=["vec_id", "label", "vector", "code", "near", "lower", "outer", "error"])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def first_assignment(vectors: DataFrame, book: np.ndarray, kept: int) -> DataFrame:
    """State rows of (vec_id, label, vector) under the first book."""
    parts = book.shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            yield _state(part, nearest(_vectors(part.column("vector"), parts), book, kept))

    return vectors.mapInArrow(run, STATE)


def next_assignment(state: DataFrame, book: np.ndarray, before: np.ndarray, kept: int) -> DataFrame:
    """State rows under ``book``, from the state for the book ``before``."""
    parts, drift = book.shape[0], drifts(before, book)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            found = _bounds(part, parts)
            yield _state(part, reassign(_vectors(part.column("vector"), parts), book, drift, *found, kept))

    return state.mapInArrow(run, STATE)


def _bounds(part: pa.RecordBatch, parts: int) -> tuple[np.ndarray, ...]:
    near = _matrix(part.column("near"))
    shape = part.num_rows, parts, near.shape[1] // parts
    lower = np.ascontiguousarray(_matrix(part.column("lower"))).view(np.float16)
    outer = np.ascontiguousarray(_matrix(part.column("outer"))).view(np.float16)
    return (_matrix(part.column("code")).astype(np.int64), near.reshape(shape).astype(np.int64),
            lower.reshape(shape), outer)


def drifts(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """How far each entry went, rounded up."""
    return np.sqrt(((after - before) ** 2).sum(axis=2).astype(np.float64)) * (1 + MARGIN)


def averaged(state: DataFrame, book: np.ndarray) -> np.ndarray:
    """The book with every used entry at the floor of the mean of its parts."""
    parts, entries, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, width), np.int64)
        count = np.zeros(parts * entries, np.int64)
        for part in _slices(batches):
            vectors = _vectors(part.column("vector"), parts)
            slots = (_matrix(part.column("code")).astype(np.int64) + np.arange(parts) * entries).ravel()
            np.add.at(total, slots, vectors.reshape(-1, width))
            count += np.bincount(slots, minlength=parts * entries)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, width)), pa.array(np.tile(np.arange(width), len(used))),
             pa.array(total[used].ravel()), pa.array(np.repeat(count[used], width))],
            names=["slot", "at", "total", "n"])

    # Whole numbers of 38 digits: the sum over all rows can't overflow. One row a component.
    sums = (state.select("vector", "code").mapInArrow(run, "slot long, at long, total long, n long")
            .groupBy("slot", "at").agg(F.sum(F.col("total").cast("decimal(28,0)")).alias("total"), F.sum("n").alias("n")))
    moved = book.reshape(parts * entries, width).copy()
    for slot, at, total, n in sums.collect():
        moved[slot, at] = int(total) // n
    return moved.reshape(book.shape)


def entries_needed(state: DataFrame, book: np.ndarray, before: np.ndarray, quantile: float = 0.9) -> int:
    """Entries beside its own that ``quantile`` of the parts need once the book has moved;
    counted from bounds and own distances, over all rows."""
    parts, entries, _ = book.shape
    drift = drifts(before, book)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(entries + 1, np.int64)
        for part in _slices(batches):
            code, near, lower, outer = _bounds(part, parts)
            vectors = _vectors(part.column("vector"), parts)
            own = book[np.arange(parts)[None, :], code]
            upper = np.sqrt(((vectors - own) ** 2).sum(axis=2).astype(np.float64)) * (1 + MARGIN)
            moved = lower.astype(np.float64) - drift[np.arange(parts)[None, :, None], near]
            needed = (moved <= upper[:, :, None]).sum(axis=2)
            needed[outer.astype(np.float64) - drift.max(axis=1)[None, :] <= upper] = entries
            seen += np.bincount(needed.ravel(), minlength=entries + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(entries + 1)), pa.array(seen)], names=["needed", "n"])

    counts = dict(state.mapInArrow(run, "needed long, n long").groupBy("needed").agg(F.sum("n")).collect())
    total, held = sum(counts.values()), 0
    for needed in range(entries + 1):
        held += counts.get(needed, 0)
        if held >= quantile * total:
            return needed
    return entries


def adapted(needed: int, entries: int) -> int:
    """``b`` for the next state: what was needed, within its limits."""
    most = max(1, entries // 8)
    return min(most, max(LEAST_KEPT, needed), max(1, entries - 1))


def compress(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of each usable vector, and the final codebooks.

    ``code`` is a byte for each part; ``error`` the squared distance summed over parts. The
    books start as the parts of the vectors with the ``entries`` smallest vec_ids (fewer
    where there aren't as many; equal ids ordered by their vectors, null ids last).
    Codebooks are (parts, entries, width) whole numbers.

    Rows :func:`whole_vectors` drops have no code, nor have vectors of another length than
    the first one's. Null labels and ids, repeated rows and ties are coded like others; an
    empty table gives no rows and books of width 0. Only vec_id, embedding and label are read.
    """
    if not 0 < entries <= 256:
        raise ValueError("an index is one byte")
    vectors = whole_vectors(table, parts)
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vector").limit(1).collect()
    if not first:
        empty = vectors.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("bigint").alias("error"))
        return empty.where("false"), np.zeros((parts, 0, 0), np.int64)
    size = len(first[0].vector)
    vectors = vectors.where(F.size("vector") == size)
    seeds = vectors.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vector").limit(entries).collect()
    book = np.array([r.vector for r in seeds], np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2).copy()
    kept = adapted(len(seeds), len(seeds))
    state = materialize(first_assignment(vectors, book, kept), "codes")
    for _ in range(rounds):
        before, book = book, averaged(state, book)
        kept = adapted(entries_needed(state, book, before), book.shape[1])
        state = materialize(next_assignment(state, book, before, kept), "codes", replaces=[state])
    return state.select("vec_id", "label", "code", "error"), book


def books_text(book: np.ndarray) -> str:
    """All components by part, entry and position, joined by commas."""
    return ",".join(map(str, book.ravel().tolist()))


def report(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each usable vector.

    ``label_error`` sums the errors of equal labels, nulls together (null where the sum
    passes a long); other cases as in :func:`compress`.
    """
    coded, book = compress(table, parts, entries, rounds)
    sums = coded.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    joined = coded.alias("c").join(sums.alias("s"), F.col("c.label").eqNullSafe(F.col("s.label")))
    return joined.select(
        "c.vec_id", F.lower(F.hex("c.code")).alias("code"), "c.error", "s.label_error",
        F.lit(sha256(books_text(book).encode()).hexdigest()).alias("codebooks_sha256"))
