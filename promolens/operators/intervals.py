"""Interval operators: what is active in each month, by merging and sweeping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def months_active(df: DataFrame, start_col: str, end_col: str,
                  from_date: dt.date, to_date: dt.date) -> DataFrame:
    """Rows of ``df`` times each month start ``m`` of [from, to] such that
    ``start <= last_day(m)`` (as a midnight datetime) and
    ``coalesce(end, far future) >= m``.

    Instead of a theta join of months against intervals (a nested-loop
    join), every interval is clipped to the range and expanded with
    ``sequence`` into the months it touches; the result feeds ordinary
    hash aggregations. Work is linear in the output size.
    """
    first = dt.date(from_date.year, from_date.month, 1)
    last = dt.date(to_date.year, to_date.month, 1)
    df = df.where(F.col(start_col).isNotNull())  # an unknown start is not before any month's end
    start = F.col(start_col)
    s_month = F.trunc(start.cast("date"), "month")
    # A start later than midnight of its month's last day misses that month.
    lo = F.when(start > F.last_day(start.cast("date")).cast("timestamp_ntz"),
                F.add_months(s_month, 1)).otherwise(s_month)
    hi = F.trunc(F.col(end_col).cast("date"), "month")
    lo_c = F.greatest(lo, F.lit(first))
    hi_c = F.when(F.col(end_col).isNull(), F.lit(last)).otherwise(F.least(hi, F.lit(last)))
    return (df.withColumn("_lo", lo_c).withColumn("_hi", hi_c)
            .where(F.col("_lo") <= F.col("_hi"))
            .withColumn("MonthStart", F.explode(F.sequence(F.col("_lo"), F.col("_hi"), F.expr("interval 1 month"))))
            .drop("_lo", "_hi"))


def month_spine(spark: SparkSession, from_date: dt.date, to_date: dt.date) -> DataFrame:
    """(MonthStart): the first days of all months of [from, to]; one row a month."""
    first, last = dt.date(from_date.year, from_date.month, 1), dt.date(to_date.year, to_date.month, 1)
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))).alias("MonthStart"))


def active_per_month(df: DataFrame, id_col: str, start_col: str, end_col: str, from_date: dt.date, to_date: dt.date) -> DataFrame:
    """(MonthStart, active): how many ids are active in each month of [from, to], by the
    overlap rule of ``months_active``; months without an active id are absent.

    The intervals of one id that overlap are merged, an interval counts +1 in its
    first month and -1 in the month after its last, and the counts are running
    sums over the months. Nothing is expanded by the length of an interval. An
    id's intervals are reduced to the distinct month ranges within [from, to] before they meet,
    so an id with many rows brings a number that depends on the months alone.
    """
    first, last = (12 * d.year + d.month - 1 for d in (from_date, to_date))

    def month(c: F.Column) -> F.Column:
        return 12 * F.year(c) + F.month(c) - 1

    start, end = F.col(start_col), F.col(end_col)
    # A start later than midnight of its month's last day misses that month.
    late = (start > F.last_day(start.cast("date")).cast("timestamp_ntz")).cast("int")
    ranges = (df.where(start.isNotNull())
              .select(F.col(id_col).alias("id"), F.greatest(month(start) + late, F.lit(first)).alias("lo"),
                      F.least(F.coalesce(month(end), F.lit(last)), F.lit(last)).alias("hi"))
              .where(F.col("lo") <= F.col("hi")).distinct())
    before = Window.partitionBy("id").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("id").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = F.coalesce((F.col("lo") > F.max("hi").over(before)).cast("int"), F.lit(1))
    merged = (ranges.withColumn("opens", opens).withColumn("part", F.sum("opens").over(upto))
              .groupBy("id", "part").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    events = (merged.select(F.explode(F.array(F.struct(F.col("lo").alias("k"), F.lit(1).alias("d")),
                                              F.struct((F.col("hi") + 1).alias("k"), F.lit(-1).alias("d")))).alias("e"))
              .groupBy("e.k").agg(F.sum("e.d").alias("d")))
    spine = month_spine(df.sparkSession, from_date, to_date).withColumn("k", month(F.col("MonthStart")))
    so_far = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row per month
    return (spine.join(events, "k", "left").withColumn("active", F.sum(F.coalesce("d", F.lit(0))).over(so_far))
            .where(F.col("active") > 0).select("MonthStart", "active"))
