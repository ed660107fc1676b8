import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from corvane.llm import mixing


@pytest.mark.parametrize("shares", [{0: 1}, {0: 3, 1: 1}, {0: 7, 1: 5, 2: 5, 3: 3}, {0: 500, 1: 1, 2: 13}])
def test_period_deviates_less_than_one_block(shares):
    order, total = mixing.period_of(shares), sum(shares.values())
    assert Counter(order) == shares
    seen = Counter()
    for t, source in enumerate(order, 1):
        seen[source] += 1
        assert all(abs(seen[s] - t * a / total) < 1 for s, a in shares.items())


def plain(shares, blocks):
    """Slots by simulation, one slot at a time, phase after phase."""
    left, out, done = {s: n for s, n in blocks.items() if n}, {}, Counter()
    slot = 0
    while left:
        order = mixing.period_of(dict(zip(sorted(left), mixing.lowest([shares[s] for s in sorted(left)]))))
        i, ended = 0, False
        while not ended:
            s = order[i % len(order)]
            out[s, done[s]] = slot
            done[s] += 1
            left[s] -= 1
            ended = not left[s]
            slot, i = slot + 1, i + 1
        left = {s: n for s, n in left.items() if n}
    return out


def test_phases_follow_simulation():
    rng = random.Random(3)
    for _ in range(20):
        shares = {s: rng.randint(1, 9) for s in range(rng.randint(1, 5))}
        blocks = {s: rng.randint(0, 60) for s in shares}
        spans, places = mixing.phases(shares, blocks)
        slot_of = {(s, p, at): slot for s, p, at, slot in places}
        got = {}
        for s, phase, first, stop, share, period, start in spans:
            for j in range(first, stop):
                turn, at = divmod(j - first, share)
                got[s, j] = start + turn * period + slot_of[s, phase, at]
        assert got == plain(shares, blocks)


def documents(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a"] * 6 + ["b", "b", "c"]), "body", "clash") for i in range(900)]
    rows += [(None, None, None, None), (3, "a", "body", "clash"), (3, "a", "body", "clash"), (900, "", "", None)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, slot string")


def test_every_row_gets_one_place(spark):
    docs = documents(spark)
    got = mixing.mix(docs, {"a": 1.0, "b": 2.0, "c": 1.0}, block_docs=4).collect()
    assert len(got) == 904 and len({r.position for r in got}) == 904
    blocks = defaultdict(set)
    for r in got:
        key = r.source if r.source in ("a", "b", "c") else None
        blocks[key].add((r.block, r.slot))
        assert r.position // 4 == r.slot
    assert {k: len(v) for k, v in blocks.items()} == {
        k: -(-sum((r.source if r.source in ("a", "b", "c") else None) == k for r in got) // 4) for k in blocks}
    slots = sorted(s for v in blocks.values() for _, s in v)
    assert slots == list(range(len(slots)))
    # While all sources have blocks, each is less than one block off its weight.
    n = {k: len(v) for k, v in blocks.items()}
    shares = dict(zip(["a", "b", "c", None], [3, 6, 3, 4]))
    at = {slot: k for k, v in blocks.items() for _, slot in v}
    seen, t = Counter(), 0
    while all(seen[k] < n[k] for k in n):
        seen[at[t]] += 1
        t += 1
        assert all(abs(seen[k] - t * shares[k] / sum(shares.values())) < 1 for k in n)


def test_derived_weights_and_empty(spark):
    docs = documents(spark)
    got = mixing.mix(docs).collect()
    assert len({r.position for r in got}) == 904
    assert sorted(c for c in mixing.mix(docs.limit(0)).columns) == sorted(docs.columns + ["block", "position"])
    assert mixing.mix(docs.limit(0)).count() == 0
    again = {(r.doc_id, r.position) for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.position) for r in got}
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 0.0})


@pytest.mark.parametrize("weights", [{0: 1, 1: 2}, {0: 1, 1: 1_000_000}, {0: 0.1, 1: 0.2, 2: 0.7},
                                     {0: Fraction(1, 3), 1: Fraction(1, 7), 2: 1.5}, {0: 355, 1: 113, 2: 997}])
def test_deviation_from_the_given_weights(weights):
    """Over 60,000 slots and more, against the weights themselves, not against shares."""
    shares = dict(zip(weights, mixing.exact_shares(list(weights.values()))))
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    total, ends = sum(exact.values()), 70_000
    blocks = {s: math.ceil(ends * w / total) + 1 for s, w in exact.items()}
    spans, places = mixing.phases(shares, blocks)
    slot_of = {(s, p, at): slot for s, p, at, slot in places}
    order = {}
    for s, phase, first, stop, share, period, start in spans:
        for j in range(first, stop) if phase == 0 else ():
            turn, at = divmod(j - first, share)
            order[start + turn * period + slot_of[s, phase, at]] = s
    assert len(order) > 60_000 and sorted(order) == list(range(len(order)))
    seen = Counter()
    for t in range(len(order)):
        seen[order[t]] += 1
        for s, w in exact.items():
            # Whole numbers: |seen - (t + 1) * w / total| < 1.
            assert abs(seen[s] * total - (t + 1) * w) < total


def test_derived_weights_stay_near_the_roots():
    counts = {0: 400_000, 1: 37, 2: 90_001}
    blocks = {c: -(-n // 8) for c, n in counts.items()}
    slots = 2 * sum(blocks.values())
    ratio = mixing.shares_of([n ** 0.5 for n in counts.values()], slots)
    roots = sum(n ** 0.5 for n in counts.values())
    for share, n in zip(ratio, counts.values()):
        assert abs(share / sum(ratio) - n ** 0.5 / roots) * sum(blocks.values()) < 0.5


def test_too_long_period():
    with pytest.raises(ValueError):
        mixing.phases({0: 1, 1: mixing.MAX_PLACES}, {0: 5, 1: mixing.MAX_PLACES})
    with pytest.raises(ValueError):
        mixing.exact_shares([1, 0])


def test_columns_of_any_name(spark):
    odd = ["class_", "place_", "at_", "tie_", "part_", "name_", "phase_", "row_", "a.b", "block", "shift_", "n"]
    docs = documents(spark).select("doc_id", "source", "text", *[F.lit(i).alias(c) for i, c in enumerate(odd)])
    got = mixing.mix(docs)
    kept = [c for c in odd if c != "block"]
    assert got.columns == ["doc_id", "source", "text", *kept, "block", "slot", "position"]
    assert {tuple(r)[3:-3] for r in got.collect()} == {tuple(i for i, c in enumerate(odd) if c != "block")}
