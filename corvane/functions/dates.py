"""Expressions over log dates of the form ``Sun Jan 23 00:10:00 +0000 2011``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Month abbreviations in the log's date format.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun",
          "jul", "aug", "sep", "oct", "nov", "dec"]


def log_date_parts(date: Column | str) -> tuple[Column, Column, Column, Column]:
    """(well formed, month, day, hour text) of a log date string."""
    # Trailing empty fields do not count.
    fields = F.split(F.rtrim(date, F.lit(" ")), " ")
    well_formed = F.size(fields) >= 6
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.get(fields, F.lit(1))))
    day = F.get(fields, F.lit(2)).cast("int")
    hour = F.split_part(F.get(fields, F.lit(3)), F.lit(":"), F.lit(1))
    return well_formed, month, day, hour
