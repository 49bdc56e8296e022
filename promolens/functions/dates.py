"""Date helpers expressed with built-in Spark functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_start(ts: Column) -> Column:
    """First day of the month as DATE (DATEFROMPARTS(y, m, 1))."""
    return F.trunc(ts.cast("date"), "month")


def year_month_label(d: Column) -> Column:
    """'yyyy-MM' text of a date (CONVERT(char(7), d, 126))."""
    return F.date_format(d, "yyyy-MM")


def in_half_open_day_range(ts: Column, from_date: dt.date, to_date: dt.date) -> Column:
    """ts >= from AND ts < to + 1 day: the whole last day is included and
    the column stays bare so the predicate reaches the Parquet scan."""
    return (ts >= F.lit(from_date).cast("timestamp_ntz")) & (
        ts < F.lit(to_date + dt.timedelta(days=1)).cast("timestamp_ntz"))


def in_closed_range(ts: Column, from_date: dt.date, to_date: dt.date) -> Column:
    """ts >= from AND ts <= to: on a datetime the last day counts only at
    midnight, as in the report it mirrors."""
    return (ts >= F.lit(from_date).cast("timestamp_ntz")) & (ts <= F.lit(to_date).cast("timestamp_ntz"))
