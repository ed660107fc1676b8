"""Hourly counts of a record log.

``log`` holds ``date`` (text such as ``Sun Jan 23 00:10:00 +0000 2011``) or ``ts``
(a timestamp), and ``content``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from corvane.functions.dates import log_date_parts

# The default window and keyword.
FIRST_DAY = (1, 23)
LAST_DAY = (2, 8)
KEYWORDS = "(?i)egypt|cairo"


def _count_hours(rows: DataFrame) -> DataFrame:
    return rows.groupBy("day", "hour").agg(F.count(F.lit(1)).alias("cnt"))


def hourly_counts(log: DataFrame, start: tuple[int, int] = FIRST_DAY,
                  end: tuple[int, int] = LAST_DAY) -> DataFrame:
    """(day "M/D", hour "HH", cnt) of the records dated from start to end.

    Bounds are (month, day), both included; the year of a record is not looked at.
    """
    well_formed, month, day, hour = log_date_parts("date")
    on = month * 100 + day
    rows = (log.where(well_formed)
            .where((month > 0) & on.between(start[0] * 100 + start[1], end[0] * 100 + end[1]))
            .select(F.concat_ws("/", month.cast("string"), day.cast("string")).alias("day"),
                    hour.alias("hour")))
    return _count_hours(rows)


def matching(log: DataFrame, pattern: str = KEYWORDS) -> DataFrame:
    """Records whose content has a match of the pattern anywhere."""
    return log.where(F.col("content").rlike(pattern))


def hourly_counts_matching(log: DataFrame, pattern: str = KEYWORDS,
                           start: tuple[int, int] = FIRST_DAY,
                           end: tuple[int, int] = LAST_DAY) -> DataFrame:
    """``hourly_counts`` of the records that match the pattern."""
    return hourly_counts(matching(log, pattern), start, end)


def hourly_counts_between(log: DataFrame, start: date, end: date) -> DataFrame:
    """``hourly_counts`` for a log with timestamps; both days included.

    The bounds are plain comparisons on ``ts``, so they reach the file scan.
    """
    after = F.date_add(F.lit(end), 1).cast("timestamp")
    rows = (log.where((F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < after))
            .select(F.date_format("ts", "M/d").alias("day"), F.date_format("ts", "HH").alias("hour")))
    return _count_hours(rows)


def padded_keys(counts: DataFrame) -> DataFrame:
    """(key "M/DD HH", cnt): the same counts under a single zero-padded key."""
    month, day = F.split_part("day", F.lit("/"), F.lit(1)), F.split_part("day", F.lit("/"), F.lit(2))
    return counts.select(
        F.concat(month, F.lit("/"), F.lpad(day, 2, "0"), F.lit(" "), "hour").alias("key"), "cnt")
