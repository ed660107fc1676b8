"""Mixing sources to target weights by Pfair scheduling.

A source with share ``a`` of ``H`` gives its block ``j`` (from 0) the release time
``floor(j * H / a)`` and the deadline ``ceil((j + 1) * H / a)`` in slots of the mix. Every
slot goes to the released block with the earliest deadline; of equal deadlines to the
one whose window overlaps its successor's, then to the first source. At any point of a phase
each source is less than one block away from its weight.

Given weights are exact: they are fractions, and ``H`` is their sum in lowest terms.
Derived weights become whole shares of a period of twice as many slots as there are blocks, so
rounding moves no source by a quarter of a block, as far as ``MAX_PLACES`` allows.
The order repeats after ``H`` slots: one period is laid out for the bounded list of
weighted sources, and every block finds its slot by a join on (source, place in the
period). When a source runs out, the others go on with their shares in a new period (a
phase), so every document is placed once.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import DataFrame, Window, functions as F

from corvane.plans.scratch import materialize

BLOCK_DOCS = 8
PERIOD = 2_000  # least period of derived weights
MAX_PLACES = 1_000_000  # slots laid out on the driver for all phases together
MAX_SOURCES = 500
TEMPERATURE = 0.5


def shares_of(weights: Sequence[float], period: int = PERIOD) -> list[int]:
    """Whole shares, at least 1 each, that sum to about ``period``."""
    if any(w <= 0 for w in weights):
        raise ValueError("weights must be positive")
    total = sum(weights)
    return [max(1, round(period * w / total)) for w in weights]


def exact_shares(weights: Sequence[float | Fraction]) -> list[int]:
    """The least whole numbers in the ratio of the weights; a float stands for its decimal form."""
    exact = [Fraction(str(w)) if isinstance(w, float) else Fraction(w) for w in weights]
    if any(w <= 0 for w in exact):
        raise ValueError("weights must be positive")
    whole = [int(w * math.lcm(*[x.denominator for x in exact])) for w in exact]
    return lowest(whole)


def lowest(shares: Sequence[int]) -> list[int]:
    return [s // math.gcd(*shares) for s in shares]


def period_of(shares: Mapping[int, int], most: int | None = None) -> list[int]:
    """The source of every slot of one period, of the first ``most`` at most, earliest deadline first."""
    total = sum(shares.values())
    waiting = [(0, source, 0) for source in shares]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int, int]] = []
    out = []
    for slot in range(total if most is None else min(most, total)):
        while waiting and waiting[0][0] <= slot:
            _, source, j = heapq.heappop(waiting)
            end = (j + 1) * total
            overlap = int(end % shares[source] > 0)
            heapq.heappush(ready, (-(-end // shares[source]), -overlap, source, j))
        _, _, source, j = heapq.heappop(ready)
        out.append(source)
        if j + 1 < shares[source]:
            heapq.heappush(waiting, ((j + 1) * total // shares[source], source, j + 1))
    return out


def phases(shares: Mapping[int, int], blocks: Mapping[int, int]) -> tuple[list[tuple], list[tuple]]:
    """Rows (source, phase, first block, next block, share, period, start slot) and
    (source, phase, place, slot in the period).

    A phase ends with the slot after which some source has no block left, so it has no more
    slots than there are blocks left. Phases that lay out more than ``MAX_PLACES``
    slots raise ValueError: then simpler weights are needed.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    start, phase, spans, places = 0, 0, [], []
    while left:
        active = dict(zip(sorted(left), lowest([shares[s] for s in sorted(left)])))
        period, ahead = sum(active.values()), sum(left.values())
        if len(places) + min(period, ahead) > MAX_PLACES:
            raise ValueError(f"the weights need more than {MAX_PLACES} slots until they repeat")
        order = period_of(active, ahead)
        slots: dict[int, list[int]] = {s: [] for s in active}
        for slot, source in enumerate(order):
            slots[source].append(slot)

        def last_slot(source: int) -> float:
            """Slot of the source's last block, counted from the start of the phase."""
            turns, place = divmod(left[source] - 1, active[source])
            return turns * period + slots[source][place] if place < len(slots[source]) else math.inf

        length = min(map(last_slot, active)) + 1
        turns, rest = divmod(length, period)
        for s in active:
            used = turns * active[s] + sum(slot < rest for slot in slots[s])
            spans.append((s, phase, done[s], done[s] + used, active[s], period, start))
            places += [(s, phase, place, slot) for place, slot in enumerate(slots[s])]
            done[s] += used
            left[s] -= used
        left = {s: n for s, n in left.items() if n > 0}
        start, phase = start + length, phase + 1
    return spans, places


def _numbered(docs: DataFrame) -> DataFrame:
    """(row_, class_) rows with ``place_``, the row's number from 0 within its ``class_``.

    The order is a hash of doc_id, then doc_id. The sort is partitioned by range, so a
    source of any size is dealt over tasks; each task's rows continue the counts of the
    tasks before it.
    """
    order = [F.col("class_"), F.xxhash64("row_.doc_id"), F.col("row_.doc_id"), F.col("tie_")]
    spread = (docs.withColumn("tie_", F.monotonically_increasing_id())
              .repartitionByRange(*order).sortWithinPartitions(*order).drop("tie_")
              .withColumn("at_", F.monotonically_increasing_id()))
    stored = materialize(spread, "mix_order")
    part = F.shiftrightunsigned("at_", 33)
    # Ranges follow the class, so there are no more rows than tasks and classes together.
    runs = (stored.groupBy("class_", part.alias("part_"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("at_").alias("low")))
    before = F.sum("n").over(Window.partitionBy("class_").orderBy("part_")) - F.col("n")
    offsets = runs.select("class_", "part_", (before - F.col("low")).alias("shift_"))
    return (stored.withColumn("part_", part)
            .join(F.broadcast(offsets), ["class_", "part_"])
            .withColumn("place_", F.col("at_") + F.col("shift_"))
            .drop("part_", "shift_", "at_"))


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, block_docs: int = BLOCK_DOCS,
        period: int | None = None, max_sources: int = MAX_SOURCES, source: str = "source") -> DataFrame:
    """``docs`` with ``block`` (number within the source), ``slot`` and ``position`` in the mix.

    ``weights`` names up to ``max_sources`` sources; without it the ``max_sources`` largest
    sources weigh the square root of their documents. All other sources and null are mixed
    as one source, which weighs the square root of its documents against the named ones
    when weights are derived, and the mean named weight when they are given. Given weights
    hold exactly; weights whose order takes more than ``MAX_PLACES`` slots to repeat raise
    ValueError. Derived weights are rounded to shares of ``period`` slots; unset, it is twice the blocks, at
    least ``PERIOD``, and at most ``MAX_PLACES`` slots over all phases.

    A block is ``block_docs`` rows; positions are distinct and every row gets one, rows that
    repeat an id and rows without one too. Texts aren't read, so their length and nulls don't matter.
    An empty table gives no rows. Columns named block, slot or position are
    replaced, all others stay as they are, whatever their names.
    """
    spark = docs.sparkSession
    if weights is not None and len(weights) > max_sources:
        raise ValueError(f"at most {max_sources} sources can be weighted")
    kept = [c for c in docs.columns if c not in ("block", "slot", "position")]
    sizes = docs.groupBy(F.col(f"`{source}`").cast("string").alias("name_")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        named = [(r.name_, r.n) for r in sizes.where("name_ IS NOT NULL")
                 .orderBy(F.desc("n"), "name_").limit(max_sources).collect()]
        names = sorted(name for name, _ in named)
    else:
        names = sorted(weights)
    classes = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name_ string, class_ int")
    rest = len(names)
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row_")
    tagged = (docs.select(row, F.col(f"`{source}`").cast("string").alias("name_"))
              .join(F.broadcast(classes), "name_", "left")  # at most max_sources rows
              .select("row_", F.coalesce("class_", F.lit(rest)).alias("class_")))
    rows = _numbered(tagged)
    counts = {r.class_: r.n for r in rows.groupBy("class_").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = {c: -(-n // block_docs) for c, n in counts.items()}
    present = sorted(counts)
    if weights is None:
        slots = period or max(PERIOD, min(2 * sum(blocks.values()), MAX_PLACES // (2 * max(1, len(present)))))
        ratio = shares_of([counts[c] ** TEMPERATURE for c in present], slots) if present else []
    else:
        given = dict(enumerate(exact_shares([weights[n] for n in names]) if names else []))
        given[rest] = Fraction(sum(given.values()), len(given)) if given else 1
        ratio = exact_shares([given[c] for c in present]) if present else []
    shares = dict(zip(present, ratio))
    spans, places = phases(shares, blocks)
    span = spark.createDataFrame(spans, "class_ int, phase_ int, first_ long, next_ long, share_ long, "
                                        "period_ long, start_ long")
    place = spark.createDataFrame(places, "class_ int, phase_ int, turn_place_ long, turn_slot_ long")
    # Both tables are bounded: phases x sources, and MAX_PLACES rows.
    within = F.col("block") - F.col("first_")
    placed = (rows.withColumn("block", F.floor(F.col("place_") / block_docs))
              .join(F.broadcast(span), "class_")
              .where((F.col("block") >= F.col("first_")) & (F.col("block") < F.col("next_")))
              .withColumn("turn_place_", within % F.col("share_"))
              .join(F.broadcast(place), ["class_", "phase_", "turn_place_"])
              .withColumn("slot", F.col("start_") + F.floor(within / F.col("share_")) * F.col("period_")
                          + F.col("turn_slot_"))
              .withColumn("position", F.col("slot") * block_docs + F.col("place_") % block_docs))
    return placed.select(*[F.col("row_").getField(c).alias(c) for c in kept], "block", "slot", "position")
