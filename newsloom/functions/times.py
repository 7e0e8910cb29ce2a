"""Time functions as Column expressions; the session runs in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_utc(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def plain_utc(c: Column) -> Column:
    return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit(" (UTC)"))


def age_days(c: Column, now: Column) -> Column:
    """Whole days from c to now."""
    return F.timestamp_diff("DAY", c, now)


def month_id(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c)


def file_time(name: Column) -> Column:
    """The timestamp in a file name like x-2024-01-31T10-20-30Z.xml.gz; null where there is none."""
    got = F.regexp_extract(name, r"(\d{4}-\d\d-\d\dT\d\d-\d\d-\d\dZ)", 1)
    return F.when(got != "", F.try_to_timestamp(got, F.lit("yyyy-MM-dd'T'HH-mm-ss'Z'")))
