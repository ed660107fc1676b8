import random

from conftest import rows
from pyspark.sql import functions as F

from corvane.operators import inverted, retrieval
from corvane.sources import ranges, sinks, text


def collection(tmp_path):
    """Files with all line ends, empty lines, long lines, and one without a last line end."""
    rnd = random.Random(5)
    folder = tmp_path / "lines of text"
    folder.mkdir()
    for f in range(3):
        body = b""
        for i in range(200):
            line = ("é" * rnd.randint(0, 30) + str(i) + ("x" * 20_000 if i == 50 else "")).encode()
            body += line + rnd.choice([b"\n", b"\r\n", b"\r", b"\n\n"])
        (folder / f"part-{f}.txt").write_bytes(body + b"last")
    (folder / "part-3.txt").write_bytes(b"")
    return str(folder)


def test_lines_by_offset(spark, tmp_path):
    path = collection(tmp_path)
    whole = text.read_lines(spark, path).cache()
    fetch = ranges.line_reader(spark, path)
    assert rows(fetch(whole.select("docno"))) == rows(whole)
    some = whole.where(F.col("docno") % 7 == 0)
    assert rows(fetch(some.select("docno"))) == rows(some)
    whole.unpersist()


def test_only_asked_lines_are_read(spark, tmp_path):
    path = collection(tmp_path)
    offsets = [r.docno for r in text.read_lines(spark, path).orderBy("docno").limit(3).collect()]
    read = spark.sparkContext.accumulator(0)
    fetch = ranges.line_reader(spark, path, read)
    assert fetch(spark.createDataFrame([(o,) for o in offsets], "docno BIGINT")).count() == 3
    assert read.value <= 3 * ranges.FIRST_READ


def test_unknown_docnos_have_no_row(spark, tmp_path):
    path = collection(tmp_path)
    fetch = ranges.line_reader(spark, path)
    assert rows(fetch(spark.createDataFrame([(10**12,), (-1,), (None,)], "docno BIGINT"))) == []


def test_file_systems_unknown_to_arrow(spark, tmp_path, monkeypatch):
    path = collection(tmp_path)
    monkeypatch.setattr(ranges, "_starts_if_open", lambda *_: (_ for _ in ()).throw(ranges._NotOpened(path)))
    whole = text.read_lines(spark, path)
    assert rows(ranges.line_reader(spark, path)(whole.select("docno"))) == rows(whole)


def test_lookup_opens_the_files_of_its_terms(spark, tmp_path):
    lines = spark.createDataFrame([(i, f"t{i:04d} common") for i in range(3000)], "docno BIGINT, text STRING")
    path = str(tmp_path / "index")
    # Small ranges would be merged into one file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.write_index(inverted.build_inverted_index(lines), path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole = sinks.read_index(spark, path)
    assert len(whole.inputFiles()) > 2 and sinks.index_stands(spark, path)
    found = sinks.find_terms(spark, path, ["t1234", "t1235x"])
    assert len(found.inputFiles()) == 1
    assert rows(found.select("term", "df")) == [("t1234", 1)]
    assert rows(retrieval.lookup_postings(sinks.find_terms(spark, path, ["common"]), lines, ["common"]).groupBy().count()) \
        == [(3000,)]
    for none in ([], ["A"], ["zzz"]):
        assert sinks.find_terms(spark, path, none).count() == 0
    assert not sinks.index_stands(spark, str(tmp_path / "nothing"))


def test_sorted_runs_are_the_index(spark):
    rnd = random.Random(2)
    lines = spark.createDataFrame(
        [(i * 5, " ".join(rnd.choice(["a", "b", "c", "dd", f"x{i}"]) for _ in range(6))) for i in range(4000)],
        "docno BIGINT, text STRING")
    runs = inverted.sorted_runs(lines, 1000)
    assert rows(runs.select("term", F.inline("postings"))) == rows(
        inverted.build_inverted_index(lines).select("term", F.inline("postings")))
    for r in runs.collect():
        docnos = [p.docno for p in r.postings]
        assert docnos == sorted(set(docnos)) and r.first == docnos[0]
        assert docnos[0] // 1000 == docnos[-1] // 1000
    plan = runs._jdf.queryExecution().sparkPlan().toString() + runs._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Final Plan ==")[-1].split("== Initial Plan ==")[0]
    assert plan.count("Exchange ") == 1 and "ObjectHashAggregate" not in plan
