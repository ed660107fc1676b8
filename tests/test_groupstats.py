import random
import statistics
from collections import Counter

import pytest
from conftest import rows

from corvane.operators import groupstats

# values, mode, median, median by the original rule
CASES = [
    ([7], 7, 7, 7),
    ([1, 3], 1, 2, 3),
    ([1, 1, 3, 3], 1, 2, 2),
    ([1, 1, 5, 5, 5, 5], 5, 5, 3),
    ([1, 2, 3], 1, 2, 2),
    ([1, 1, 1, 5], 1, 1, 1),
    ([1, 2, 2, 4], 2, 2, 2),
    ([1, 4, 4, 9], 4, 4, 4),
    ([-4, -3], -4, -3, -3),
    ([-70000, 70001], -70000, 0, 70001),
    ([1, 200000, 200000, 400000], 200000, 200000, 200000),
    ([65535, 65536, 65536, 65537, 65537, 65537], 65537, 65536, 65536),
]


@pytest.fixture(scope="module")
def obs(spark):
    data = [(str(i), v) for i, case in enumerate(CASES) for v in case[0]]
    return spark.createDataFrame(data, "k STRING, v INT")


def by_key(df):
    return {int(k): v for k, v in rows(df)}


def test_mode(obs):
    assert by_key(groupstats.group_mode(obs)) == {i: c[1] for i, c in enumerate(CASES)}


def test_median(obs):
    assert by_key(groupstats.group_median(obs)) == {i: c[2] for i, c in enumerate(CASES)}


def test_median_by_original_rule(obs):
    assert by_key(groupstats.group_median_compat(obs)) == {i: c[3] for i, c in enumerate(CASES)}


def test_narrow_values(spark, obs):
    keep = {i: c for i, c in enumerate(CASES) if all(abs(v) < 100 for v in c[0])}
    narrow = obs.where(obs.k.isin([str(i) for i in keep]))
    assert by_key(groupstats.group_median(narrow)) == {i: c[2] for i, c in keep.items()}
    assert by_key(groupstats.group_median_compat(narrow)) == {i: c[3] for i, c in keep.items()}
    assert by_key(groupstats.group_median(obs.where("false"))) == {}


def test_max(obs):
    assert by_key(groupstats.group_max(obs)) == {i: max(c[0]) for i, c in enumerate(CASES)}


def test_wide_values(spark):
    pick = random.Random(5)
    groups = {str(k): [pick.randint(-2**31, 2**31 - 1) // 10 ** pick.randint(0, 8)
                       for _ in range(pick.randint(1, 60))] for k in range(40)}
    obs = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k STRING, v INT")
    want = {k: int(statistics.median(vs)) for k, vs in groups.items()}
    assert dict(rows(groupstats.group_median(obs))) == want
    odd = {k: m for k, m in want.items() if len(groups[k]) % 2}
    compat = dict(rows(groupstats.group_median_compat(obs)))
    assert {k: compat[k] for k in odd} == odd
    counts = {(k, v, n) for k, vs in groups.items() for v, n in Counter(vs).items()}
    assert set(rows(groupstats.value_multiplicity(obs))) == counts


def compat(values):
    """The original rule: the middle rank against half of the middle value's run."""
    values = sorted(values)
    mid, counts, upto, prev = len(values) // 2 + 1, Counter(values), 0, None
    for value in sorted(counts):
        upto += counts[value]
        if upto >= mid:
            if len(values) % 2 or prev is None or 2 * upto < 2 * mid + counts[value]:
                return value
            return (prev + value) / 2
        prev = value


@pytest.mark.parametrize("task_rows", [10**6, 500])
def test_real_medians(spark, task_rows):
    """Small keys, and large ones whose middle is bracketed: spread, tied, of two values."""
    rnd = random.Random(11)
    groups = {"few": [0.1, -2.5, 1e300, 3.25], "one": [-0.0], "two": [1e-320, 2.5],
              "spread": [rnd.gauss(0, 1e6) for _ in range(9001)], "even": [rnd.random() for _ in range(8000)],
              "tied": [float(rnd.randint(0, 3)) for _ in range(8000)], "halves": [1.5] * 4000 + [2.5] * 4000,
              "rare": [1.0] * 3999 + [2.0] + [3.0] * 4000, "same": [7.0] * 5000}
    obs = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("few", None), ("null", None)],
                                "k STRING, v DOUBLE").repartition(5)
    got = dict(rows(groupstats.group_median_real(obs, task_rows=task_rows)))
    assert got == {k: pytest.approx(statistics.median(v), abs=1e-6) for k, v in groups.items()}
    got = dict(rows(groupstats.group_median_real_compat(obs, task_rows=task_rows)))
    assert got == {k: pytest.approx(compat(v), abs=1e-6) for k, v in groups.items()}


def test_real_median_of_other_types(spark):
    obs = spark.createDataFrame([("a", 1), ("a", 2)], "k STRING, v INT")
    assert rows(groupstats.group_median_real(obs)) == [("a", 1.5)]
    assert rows(groupstats.group_median_real(obs.withColumn("v", obs.v.cast("decimal(9,2)")))) == [("a", 1.5)]
    assert rows(groupstats.group_median_real(obs.where("false"))) == []
