import math
from hashlib import sha256

import numpy as np
import pytest

from corvane.llm import vectors

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """Every part against every entry in each round."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = np.floor(np.array([r[1] for r in rows], np.float64) * 256).astype(np.int64)
    whole = whole.reshape(len(rows), parts, -1)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0], whole[i].ravel().tolist()))
    book = whole[first[:entries]].transpose(1, 0, 2).copy()

    def assign():
        squares = ((whole[:, :, None, :] - book[None]) ** 2).sum(3)
        return squares.argmin(2), squares.min(2).sum(1)

    for _ in range(rounds):
        code, _ = assign()
        for p in range(parts):
            for e in range(book.shape[1]):
                held = code[:, p] == e
                if held.any():
                    book[p, e] = whole[held, p].sum(0) // held.sum()
    code, error = assign()
    sums = {}
    for r, x in zip(rows, error.tolist()):
        sums[r[2]] = sums.get(r[2], 0) + x
    digest = sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    return sorted(((r[0], bytes(c.tolist()).hex(), e, sums[r[2]], digest)
                   for r, c, e in zip(rows, code, error.tolist())), key=repr)


def reported(frame, **options):
    return sorted(map(tuple, vectors.report(frame, **options).collect()), key=repr)


def test_embeddings_table(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert reported(frame) == plain([tuple(r) for r in frame.select("vec_id", "embedding", "label").collect()])


@pytest.mark.parametrize("entries,rounds", [(1, 2), (2, 3), (7, 6), (20, 1), (20, 0)])
def test_other_settings(spark, entries, rounds):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet").limit(200)
    rows = [tuple(r) for r in frame.select("vec_id", "embedding", "label").collect()]
    assert reported(frame, parts=8, entries=entries, rounds=rounds) == plain(rows, 8, entries, rounds)


@pytest.mark.parametrize("seed", range(6))
def test_bounds_never_lose_the_nearest(seed):
    """Rounds by bounds against rounds by all distances, on vectors with many ties."""
    rnd = np.random.default_rng(seed)
    spread = [3, 30, 3000, 10**5, 10**6, 40][seed]
    whole = rnd.integers(-spread, spread, (500, 4, 3))
    whole[::3] = whole[0]
    book = whole[rnd.choice(500, 32)].transpose(1, 0, 2).copy()
    state, kept, skipped = vectors.nearest(whole, book, 6)[0:5], 6, 0
    for step in range(6):
        before = book
        book = before + rnd.integers(-spread // 10 - 1, spread // 10 + 2, book.shape) * (step % 3 != 2)
        code, error, near, lower, outer = state
        *state, needed = vectors.reassign(whole, book, vectors.drifts(before, book), code, near, lower, outer, kept)
        want = vectors.nearest(whole, book, 6)
        assert (state[0] == want[0]).all() and (state[1] == want[1]).all()
        exact = np.sqrt(vectors._squares(whole, book).astype(float))
        assert (state[3] <= np.take_along_axis(exact, state[2], 2)).all()
        others = exact.copy()
        np.put_along_axis(others, state[2], np.inf, 2)
        np.put_along_axis(others, state[0][:, :, None], np.inf, 2)
        assert (state[4].astype(float) <= np.minimum(others.min(2), 65504)).all()
        skipped += (needed == 0).sum()
        kept = max(2, kept - 1)
    assert skipped > 0


def test_rounding_down():
    values = np.concatenate((np.linspace(0, 10, 1001), np.geomspace(1e-9, 1e9, 1001)))
    assert (vectors._down(values).astype(float) <= values).all()


def test_edge_cases(spark):
    rnd = np.random.default_rng(1)

    def vector():
        return rnd.normal(size=16).round(2).tolist()

    same = vector()
    good = [(i, vector(), i % 3) for i in range(20)] + [(100 + i, same, None) for i in range(30)]
    good += [(3, vector(), 1), (None, vector(), None), (50, [0.0] * 16, 2), (50, [0.0] * 16, 2),
             (51, [-0.001] * 16, 0), (52, [1000.0] * 16, 9)]
    bad = [(200, None, 1), (201, [None] * 16, 1), (202, [float("nan")] * 16, 1), (203, [float("inf")] * 16, 1),
           (204, [], 1), (205, [1.0] * 15, 1), (206, [1.0] * 32, 1), (207, [3e38] * 16, 1)]
    frame = spark.createDataFrame(good + bad, SCHEMA)
    floats = [(i, [float(np.float32(x)) for x in v], l) for i, v, l in good]
    assert reported(frame, entries=8, rounds=3) == plain(floats, 16, 8, 3)
    clash = frame.selectExpr("*", "1 AS code", "2 AS error", "3 AS state", "4 AS scaled", "5 AS bound", "6 AS `a.b`")
    assert reported(clash, entries=8, rounds=3) == plain(floats, 16, 8, 3)


def test_empty_table(spark):
    frame = vectors.report(spark.createDataFrame([], SCHEMA))
    assert frame.collect() == []
    assert dict(frame.dtypes) == {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint",
                                  "codebooks_sha256": "string"}


def test_kept_entries_adapt():
    assert vectors.adapted(0, 64) == 2 and vectors.adapted(5, 64) == 5 and vectors.adapted(40, 64) == 8
    assert vectors.adapted(9, 1) == 1
