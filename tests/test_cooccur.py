import itertools
import math
import random
from collections import Counter

import pytest
from conftest import rows

from corvane.operators import cooccur
from test_words import TEXT


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(TEXT, "docno BIGINT, text STRING")


@pytest.fixture(scope="module")
def many(spark):
    pick = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)] + ["%", "!", '"q']
    data = [(i, " ".join(pick.choices(vocabulary, k=pick.randint(0, 9)))) for i in range(300)]
    data += [(1000 + i, "hot word") for i in range(200)]
    return data, spark.createDataFrame(data, "docno BIGINT, text STRING")


def brute(data, support):
    lists = [set(t.split()) for _, t in data]
    df = Counter(t for s in lists for t in s)
    both = Counter(p for s in lists for p in itertools.permutations(s, 2))
    return sorted(((a, b, n, round(math.log(len(data) * n / (df[a] * df[b])), 6) + 0.0)
                   for (a, b), n in both.items() if n >= support), key=repr)


def test_pmi_fixture(lines):
    assert rows(cooccur.pmi(lines, 2)) == [
        ("a", "b", 3, 0.223144), ("a", "c", 3, 0.223144), ("b", "a", 3, 0.223144),
        ("b", "c", 2, 0.105361), ("c", "a", 3, 0.223144), ("c", "b", 2, 0.105361)]


def test_given_collection_size(lines):
    scored = dict((r[:2], r[3]) for r in rows(cooccur.pmi(lines, 2, n_docs=10)))
    assert scored[("a", "b")] == round(math.log(10 * 3 / 12), 6)


@pytest.mark.parametrize("support", [1, 3])
@pytest.mark.parametrize("task_rows", [10, 1_000_000])
def test_against_brute_force(many, support, task_rows):
    data, lines = many
    assert rows(cooccur.pmi(lines, support, task_rows=task_rows)) == brute(data, support)


def test_stripes_equal_pairs(many):
    _, lines = many
    stripes = cooccur.cooccurrence_stripes(lines, 2, entries=9)
    assert rows(cooccur.stripe_rows(stripes)) == rows(cooccur.cooccurrence_pairs(lines, 2))
    assert stripes.groupBy("a", "block").count().where("count > 1").isEmpty()
    assert stripes.select("block").distinct().count() > 1
    ids = {t: i // 9 for i, t in enumerate(sorted({r[0] for r in rows(stripes, "a")}, key=str.encode))}
    assert all(block == ids[b] for _, block, b, _ in rows(
        stripes.selectExpr("a", "block", "explode(stripe) AS (b, n)")))
    whole = cooccur.cooccurrence_stripes(lines, 2)
    assert whole.count() == whole.select("a").distinct().count()


@pytest.mark.parametrize("task_rows", [10, 1_000_000])
def test_long_lines_are_cut(many, monkeypatch, task_rows):
    data, lines = many
    monkeypatch.setattr(cooccur._counted_pairs, "__defaults__", (3,))
    assert rows(cooccur.pmi(lines, 1, task_rows=task_rows)) == brute(data, 1)


def test_best_pairs(lines):
    scored = cooccur.pmi(lines, 1)
    best = max(rows(scored), key=lambda r: (r[3], ))
    assert rows(cooccur.max_pmi_pair(scored)) == [("a", "b", 0.223144)] and best[3] == 0.223144
    assert rows(cooccur.top_pmi_for_word(scored, ["a", "zz"], 2)) == [
        ("a", 1, "b", 0.223144), ("a", 2, "c", 0.223144)]


def test_pairs_are_counted_in_rounds_that_keep_to_the_size_of_the_lines(many, monkeypatch):
    data, frame = many
    stored = []
    keep = cooccur.materialize

    def kept(df, name, *args, **options):
        stored.append(name)
        return keep(df, name, *args, **options)

    monkeypatch.setattr(cooccur, "materialize", kept)
    monkeypatch.setattr(cooccur, "ROUND_PARTNERS", 1)
    terms = cooccur._frequent_terms(frame, 2)
    pairs = cooccur._counted_pairs(frame, terms, 2, cooccur.TASK_ROWS, least_round=1)
    assert rows(cooccur._both_orders(pairs, "n"), "a", "b", "n") == sorted(
        ((a, b, n) for a, b, n, _ in brute(data, 2)), key=repr)
    assert stored.count("pairs") > 1 and stored.count("line_terms") == cooccur.TERM_ROUNDS
