import random

import pytest
from conftest import rows

from corvane.operators import bitmaps, inverted, retrieval


def many_lines(spark, n=40_000):
    """More lines than a bitmap has bits, so that terms span several."""
    rnd = random.Random(7)
    words = ["red", "rose", "white", "pluck", "thorn"]
    return spark.createDataFrame([(i * 1_000_003, " ".join(w for w in words if rnd.random() < 0.3)) for i in range(n)],
                                 "docno BIGINT, text STRING")


QUERIES = {1: "white red OR rose AND", 2: "thorn", 3: "absent rose OR", 4: "absent rose AND",
           5: "red rose AND white pluck AND OR thorn AND", 6: "red red AND", 7: "red rose white pluck thorn OR OR OR OR"}


def test_bitmaps_answer_as_postings_do(spark):
    lines = many_lines(spark)
    index = bitmaps.build_bitmap_index(lines)
    got = rows(bitmaps.boolean_retrieval_bitmaps(index, lines, QUERIES), "qid", "docno")
    want = rows(retrieval.boolean_retrieval_batch(inverted.build_inverted_index(lines), lines, QUERIES), "qid", "docno")
    assert got == want
    assert rows(index.terms.groupBy("term").count(), "count") == [(2,)] * 5


def test_no_row_for_a_posting_in_the_algebra(spark):
    lines = spark.createDataFrame([(i, "rose red") for i in range(5000)], "docno BIGINT, text STRING")
    found = bitmaps.matching_bitmaps(bitmaps.build_bitmap_index(lines), {1: "rose red AND"})
    assert found.count() == 1
    assert bitmaps.numbers_of(found, "qid").count() == 5000


def test_borders_of_a_bitmap(spark):
    numbers = [1, 2, 8, 9, 32_768, 32_769, 65_536, 65_537]
    found = spark.createDataFrame([(x,) for x in numbers], "number BIGINT").selectExpr(
        "bitmap_bucket_number(number) AS bucket", "bitmap_bit_position(number) AS at").groupBy("bucket").agg(
        {"at": "bitmap_construct_agg"}).withColumnRenamed("bitmap_construct_agg(at)", "bits")
    assert [r[0] for r in rows(bitmaps.numbers_of(found))] == sorted(numbers, key=lambda x: repr((x,)))


@pytest.mark.parametrize("query", ["rose AND", "white rose", "", "AND"])
def test_malformed_queries(spark, query):
    lines = spark.createDataFrame([(1, "rose")], "docno BIGINT, text STRING")
    with pytest.raises(ValueError):
        bitmaps.boolean_retrieval_bitmaps(bitmaps.build_bitmap_index(lines), lines, {1: query})


def test_empty_collection(spark):
    lines = spark.createDataFrame([], "docno BIGINT, text STRING")
    assert rows(bitmaps.boolean_retrieval_bitmaps(bitmaps.build_bitmap_index(lines), lines, QUERIES)) == []
