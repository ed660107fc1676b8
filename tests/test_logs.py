from datetime import date

import pytest
from conftest import rows

from corvane.operators import logs
from corvane.sources import text as readers

RECORDS = [
    "1\tSun Jan 23 00:10:00 +0000 2011\tu\tin Egypt",
    "2\tSun Jan 23 00:20:00 +0000 2011\tu\tx",
    "3\tTue Feb 08 23:59:59 +0000 2011\tu\teGYPtian",
    "4\tWed Feb 09 00:00:00 +0000 2011\tu\tcairo",
    "5\tSat Jan 22 23:00:00 +0000 2011\tu\tegypt",
    "6\tSun Jan 23 05:00:00 +0000 2011\tu\t",
    "7\tSun Jan 23 05:00:00 +0000 2011",
    "8\tbad date\tu\tegypt",
    "9\tMon Mar 24 05:00:00 +0000 2011\tu\tegypt",
    "10\tSun FEB 06 07:00:00 +0000 1999\tu\tsays \"hi\textra",
]


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    file = tmp_path_factory.mktemp("log") / "log.txt"
    file.write_text("\n".join(RECORDS) + "\n")
    return str(file)


def test_counts(spark, path):
    log = readers.read_log(spark, path)
    assert rows(logs.hourly_counts(log)) == [("1/23", "00", 2), ("2/6", "07", 1), ("2/8", "23", 1)]
    assert rows(logs.hourly_counts_matching(log)) == [("1/23", "00", 1), ("2/8", "23", 1)]
    assert rows(logs.padded_keys(logs.hourly_counts(log))) == [
        ("1/23 00", 2), ("2/06 07", 1), ("2/08 23", 1)]


def test_content_guard(spark, path):
    log = readers.read_log(spark, path, require_content=False)
    assert ("1/23", "05", 2) in rows(logs.hourly_counts(log))


def test_typed_load(spark, path):
    log = readers.read_tsv(spark, path, "id STRING, date STRING, user STRING, content STRING")
    assert log.where("id = '10'").first().content == 'says "hi'


def test_timestamps(spark):
    log = spark.sql("""SELECT CAST(t AS TIMESTAMP) AS ts, 'c' AS content FROM VALUES
        ('2024-01-09 23:59:59.9'), ('2024-01-10 00:00:00'), ('2024-01-20 23:59:59.9'),
        ('2024-01-21 00:00:00') AS v(t)""")
    got = logs.hourly_counts_between(log, date(2024, 1, 10), date(2024, 1, 20))
    assert rows(got) == [("1/10", "00", 1), ("1/20", "23", 1)]
