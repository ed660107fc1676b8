import gzip
from pathlib import Path

import pytest
from conftest import rows

from corvane.operators import cooccur
from corvane.plans import scratch, skew
from corvane.sources import sinks, tables, text as readers


def test_text_and_gzip(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one two\nthree\n")
    with gzip.open(tmp_path / "b.gz", "wt") as f:
        f.write("four\n\n")
    lines = readers.read_text(spark, str(tmp_path), partitions=3)
    assert lines.rdd.getNumPartitions() == 3
    assert rows(lines) == [("",), ("four",), ("one two",), ("three",)]


@pytest.mark.parametrize("split", [7, 64, 128 << 20])
def test_byte_offsets(spark, tmp_path, split):
    body = "é first\n\nthird line\r\n" + "x" * 90 + "\nla\rst\r"
    (tmp_path / "part-0").write_bytes(body.encode())
    (tmp_path / "part-1").write_bytes(b"next\nfile\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        one = rows(readers.read_lines(spark, str(tmp_path / "part-0")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(one) == [(0, "é first"), (9, ""), (10, "third line"), (22, "x" * 90), (113, "la"),
                           (116, "st")]
    both = sorted(rows(readers.read_lines(spark, [str(tmp_path / "part-0"), str(tmp_path / "part-1")])))
    assert len({d for d, _ in both}) == 8 and both[:6] == sorted(one)
    assert [t for _, t in both[6:]] == ["next", "file"]


def test_offsets_equal_read_text(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"a\rb\r\n\r\n\n\r\rc")
    lines = readers.read_lines(spark, str(tmp_path / "a"))
    assert sorted(rows(lines)) == [(0, "a"), (2, "b"), (5, ""), (7, ""), (8, ""), (9, ""), (10, "c")]
    assert rows(lines, "text") == rows(readers.read_text(spark, str(tmp_path / "a")))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.index("BroadcastHashJoin") < plan.index("Exchange") and "SortMergeJoin" not in plan


def test_observations(spark, tmp_path):
    (tmp_path / "o.tsv").write_text("a\t1\nb\t2\t3\nc\nd\t-4\t\n\t5\n")
    assert rows(readers.read_observations(spark, str(tmp_path / "o.tsv"))) == [("", 5), ("a", 1), ("d", -4)]
    (tmp_path / "bad.tsv").write_text("a\tx\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_observations(spark, str(tmp_path / "bad.tsv")).collect()


def test_adjacency(spark, tmp_path):
    (tmp_path / "g.txt").write_text(" 1 2\t3 3 \n4\n\n5  1\n")
    nodes, edges = readers.read_adjacency(spark, str(tmp_path / "g.txt"))
    assert rows(nodes) == [(1,), (4,), (5,)]
    assert rows(edges) == [(1, 2), (1, 3), (1, 3), (5, 1)]
    (tmp_path / "t.txt").write_text("1\t2\t3\n4\t1\n")
    nodes, edges = readers.read_adjacency(spark, str(tmp_path / "t.txt"), tabs=True)
    assert rows(edges) == [(1, 2), (1, 3), (4, 1)]


def test_scored_pairs_round_trip(spark, tmp_path):
    lines = spark.createDataFrame([(1, "a b"), (2, "b a"), (3, "c")], "docno BIGINT, text STRING")
    scored = cooccur.pmi(lines, 1)
    sinks.write_scored_pairs(scored, str(tmp_path / "pmi"))
    back = readers.read_scored_pairs(spark, str(tmp_path / "pmi"))
    assert rows(back) == rows(scored, "a", "b", "pmi")
    assert rows(cooccur.max_pmi_pair(back)) == rows(cooccur.max_pmi_pair(scored))
    odd = spark.createDataFrame([("p\x0bq", "(r,", 1.5)], "a STRING, b STRING, pmi DOUBLE")
    sinks.write_scored_pairs(odd, str(tmp_path / "odd"))
    assert rows(readers.read_scored_pairs(spark, str(tmp_path / "odd"))) == rows(odd)
    (tmp_path / "bad").write_text("a b\t1.0\n")
    with pytest.raises(Exception, match="not a pair"):
        readers.read_scored_pairs(spark, str(tmp_path / "bad")).collect()


def test_a_document_of_a_million_lines(spark, tmp_path):
    docs = spark.createDataFrame([(1, "x\n" * 1_000_000 + "last"), (2, "y")], "doc_id BIGINT, text STRING")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    lines = tables.lines(spark, str(tmp_path), partitions=2)
    assert lines.select("docno").distinct().count() == 1_000_002
    asked = lines.where("text != 'x'").select("docno")
    got = rows(tables.line_fetcher(spark, str(tmp_path))(asked))
    assert got == [(tables.DOC_LINES + 1_000_000, "last"), (2 * tables.DOC_LINES, "y")]


def test_overwrite_and_partitions(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("k", 1), (None, 2)], "k STRING, v INT")
    for n in (3, 1):
        sinks.write_text(df, path, partitions=n)
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
    assert rows(spark.read.text(path)) == [("\t2",), ("k\t1",)]
    sinks.write_records(df, path, partitions=1)
    assert rows(sinks.read_records(spark, path)) == rows(df)


def test_partition_graph(spark, tmp_path):
    edges = spark.createDataFrame([(i % 5, i) for i in range(40)], "src BIGINT, dst BIGINT")
    assert rows(sinks.partition_graph(edges, 3, str(tmp_path / "g"))) == rows(edges)


def test_index_lookup_is_pushed_down(spark, tmp_path):
    index = spark.createDataFrame([("b", 1, 0, [(1, 1)]), ("a", 1, 0, [(2, 1)])],
                                  "term STRING, df BIGINT, shard BIGINT, "
                                  "postings ARRAY<STRUCT<docno: BIGINT, tf: BIGINT>>")
    sinks.write_index(index, str(tmp_path / "i"))
    found = sinks.read_index(spark, str(tmp_path / "i")).where("term = 'a'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,a)" in plan
    assert found.count() == 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(spark, how):
    big = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 50 + [2] * 3 + [3, 4])],
                                "k BIGINT, i BIGINT")
    small = spark.createDataFrame([(1,), (2,), (5,)], "k BIGINT")
    weights = big.groupBy("k").count().withColumnRenamed("count", "n")
    hot = skew.hot_keys(weights, ["k"], task_rows=10)
    assert rows(hot) == [(1, 5)]
    assert skew.hot_keys(weights, ["k"], task_rows=50) is None
    got = skew.skew_join(big, small, ["k"], weights, by=["i"], how=how, task_rows=10)
    assert rows(got) == rows(big.join(small, "k", how))


def test_scratch_follows_the_session(spark):
    assert scratch.scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_scratch_tables_are_dropped(spark):
    folder = Path(scratch.scratch_dir(spark))
    one = scratch.materialize(spark.range(5), "some-table")
    here = lambda: [p for p in folder.rglob("some_table_*") if p.is_dir()]
    assert len(here()) == 1
    two = scratch.materialize(one.where("id > 2"), "some-table", replaces=[one])
    assert len(here()) == 1 and rows(two) == [(3,), (4,)]
    scratch.release(two, two, spark.range(1))
    assert not here()


def test_offsets_of_runs_of_splits():
    """Rows of several splits in one batch and one split over several, some with CR."""
    import random
    import re

    import pyarrow as pa

    rng = random.Random(4)
    for _ in range(40):
        values, want = [], []
        for split in range(rng.randint(1, 4)):
            body = "".join(rng.choice(["a", "é", "\n", "\r", "\r\n", "bc"]) for _ in range(rng.randint(1, 30)))
            for value in (body[:-1] if body.endswith("\n") else body).split("\n"):
                values.append((value, "f", split))
            ends, at = re.split(r"(\r\n|\r|\n)", body), 0
            for line, end in zip(ends[::2], [*ends[1::2], ""]):
                if line or end:
                    want.append((split, at, line))
                at += len((line + end).encode())
        step, batches = rng.randint(1, 9), []
        for i in range(0, len(values), step):
            columns = zip(*values[i:i + step])
            batches.append(pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))],
                names=["value", "file", "block"]))
        got = [(r["block"], r["at"], r["text"]) for b in readers._placed(iter(batches)) for r in b.to_pylist()]
        assert sorted(got) == sorted(want)
