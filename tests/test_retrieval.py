import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corvane.operators import inverted, retrieval
from corvane.sources import sinks

TEXT = [(1, "white rose"), (2, "red rose pluck"), (3, "white red"), (4, "rose rose")]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(TEXT, "docno BIGINT, text STRING")


@pytest.fixture(scope="module")
def index(lines):
    return inverted.build_inverted_index(lines)


def docnos(index, lines, query):
    return [r[0] for r in rows(retrieval.boolean_retrieval(index, lines, query))]


def test_index(index):
    rose = index.where("term = 'rose'").first()
    assert (rose.df, [tuple(p) for p in rose.postings]) == (3, [(1, 1), (2, 1), (4, 2)])
    gaps = rows(inverted.posting_gaps(index).where("term = 'rose'"), "docno", "gap", "tf")
    assert gaps == [(1, 1, 1), (2, 1, 1), (4, 2, 2)]
    assert rows(inverted.tf_histogram(index, ["rose"])) == [("rose", 1, 2), ("rose", 2, 1)]


def test_boolean_queries(index, lines):
    assert docnos(index, lines, "white red OR rose AND") == [1, 2]
    assert docnos(index, lines, "white rose AND") == [1]
    assert docnos(index, lines, "bronze rose OR") == [1, 2, 4]
    assert docnos(index, lines, "bronze") == []
    assert docnos(index, lines, "bronze rose AND") == []


@pytest.mark.parametrize("query", ["rose AND", "white rose", "", "AND"])
def test_malformed_queries(index, lines, query):
    with pytest.raises(ValueError):
        retrieval.boolean_retrieval(index, lines, query)


def test_batch_equals_single(index, lines):
    queries = {1: "white red OR rose AND", 2: "rose", 3: "bronze white OR", 4: "pluck red AND rose AND"}
    batch = rows(retrieval.boolean_retrieval_batch(index, lines, queries))
    single = sorted(((q, *r) for q, p in queries.items()
                     for r in rows(retrieval.boolean_retrieval(index, lines, p))), key=repr)
    assert batch == single


def test_batch_of_many_terms(index, lines):
    queries = {i: f"t{i} rose OR" if i % 2 else f"t{i} white AND" for i in range(150)}
    got = rows(retrieval.boolean_retrieval_batch(index, lines, queries), "qid", "docno")
    assert sorted(got) == [(q, d) for q in range(1, 150, 2) for d in (1, 2, 4)]


def test_lookup(index, lines):
    assert rows(retrieval.lookup_postings(index, lines, ["pluck", "bronze"])) == [
        ("pluck", 1, 2, 1, "red rose pluck")]
    fetched = lambda docnos: lines.join(docnos, "docno", "left_semi")
    assert rows(retrieval.lookup_postings(index, fetched, ["pluck", "rose"])) == rows(
        retrieval.lookup_postings(index, lines, ["pluck", "rose"]))
    assert rows(retrieval.absent_terms(index, ["rose", "bronze", "bronze", "tin"])) == [("bronze",), ("tin",)]


@pytest.mark.parametrize("task_rows", [20, 1_000_000])
def test_shards_and_gaps(spark, tmp_path, task_rows):
    pick = random.Random(1)
    data = [(d * 3 + 5, " ".join(["hot"] + pick.choices("abcdefgh", k=pick.randint(0, 6))))
            for d in range(200)]
    lines = spark.createDataFrame(data, "docno BIGINT, text STRING")
    index = inverted.build_inverted_index(lines, span=50, task_rows=task_rows)
    want = sorted(((t, n, text.split().count(t)) for n, text in data for t in set(text.split())), key=repr)
    assert rows(inverted.posting_rows(index), "term", "docno", "tf") == want
    frequency = {t: sum(1 for w in want if w[0] == t) for t in {w[0] for w in want}}
    assert dict(rows(index.select("term", "df").distinct())) == frequency
    assert index.where("term = 'hot'").count() > 10
    sizes = index.select(F.max(F.size("postings"))).first()[0]
    assert sizes <= 50
    assert rows(inverted.restore_docnos(inverted.compress_postings(index))) == want
    last = {}
    gaps = []
    for t, n, f in sorted(want):
        gaps.append((t, n, n - last.get(t, 0), f))
        last[t] = n
    assert rows(inverted.posting_gaps(index)) == sorted(gaps, key=repr)
    # A stored index answers like the one in hand.
    sinks.write_index(index, str(tmp_path / "idx"))
    stored = sinks.read_index(spark, str(tmp_path / "idx"))
    assert rows(inverted.posting_rows(stored), "term", "docno", "tf") == want
    assert rows(retrieval.boolean_retrieval(stored, lines, "hot a AND b OR")) == rows(
        retrieval.boolean_retrieval(index, lines, "hot a AND b OR"))


def test_gap_coding_moves_no_lists(spark):
    data = [(i * 3, f"a b{i % 7} c{i % 3} a") for i in range(200)] + [(None, "y z")]
    frame = spark.createDataFrame(data, "docno BIGINT, text STRING")
    index = inverted.build_inverted_index(frame, span=50)
    assert {r.term for r in index.where("shard IS NULL").collect()} == {"y", "z"}
    stored = inverted.store_index(index)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = inverted.posting_gaps(stored)._jdf.queryExecution().sparkPlan().toString()
        ready = inverted.posting_gaps(stored)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The light rows are moved to their term and back to their list; the lists stay.
    assert "SortMergeJoin" not in plan and ready.count("Exchange hashpartitioning") == 2
    coded = inverted.store_index(inverted.compress_postings(stored), "gaps", replaces=[stored])
    want = sorted((t, i, n) for i, text in data if i is not None
                  for t, n in Counter(text.split()).items())
    want.sort(key=repr)
    assert rows(inverted.restore_docnos(coded), "term", "docno", "tf") == want
