import datetime as dt

from pyspark.sql import functions as F

from promolens.functions.dates import in_closed_range, in_half_open_day_range
from promolens.functions.flags import is_promotion, promo_flag_by_offer
from promolens.operators.intervals import months_active


def test_promo_flags(spark):
    rows = [(i, d) for i in (1, 2, None) for d in (0.0, 0.1, None)]
    df = spark.createDataFrame(rows, "id int, disc double")
    out = {(r["id"], r["disc"]): (r["f"], r["p"]) for r in df.select(
        "id", "disc", promo_flag_by_offer(F.col("id")).alias("f"),
        is_promotion(F.col("id"), F.col("disc")).alias("p")).collect()}
    assert out[(1, 0.1)] == ("No Promotion", 0)
    assert out[(2, 0.0)] == ("Promotion", 0)  # discount 0: the two rules differ
    assert out[(2, 0.1)] == ("Promotion", 1)
    assert out[(None, 0.1)] == ("Promotion", 1)  # NULL id falls to ELSE
    assert out[(None, None)] == ("Promotion", 1)


def test_date_edges(spark):
    ts = [dt.datetime(2014, 12, 31, 0, 0), dt.datetime(2014, 12, 31, 23, 59), dt.datetime(2015, 1, 1, 0, 0)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    a, b = dt.date(2014, 1, 1), dt.date(2014, 12, 31)
    out = df.select(in_half_open_day_range(F.col("t"), a, b).alias("h"), in_closed_range(F.col("t"), a, b).alias("c"))
    got = [(r["h"], r["c"]) for r in out.collect()]
    assert got == [(True, True), (True, False), (False, False)]


def _brute_months(start, end, first, last):
    import calendar
    out = []
    m = first
    while m <= last:
        eom = dt.datetime(m.year, m.month, calendar.monthrange(m.year, m.month)[1])
        if start <= eom and (end or dt.datetime(9999, 12, 31)) >= dt.datetime(m.year, m.month, 1):
            out.append(m)
        m = dt.date(m.year + (m.month // 12), m.month % 12 + 1, 1)
    return out


def test_months_active_matches_theta_join(spark):
    offers = [
        (1, dt.datetime(2011, 3, 15), None),                      # open end
        (2, dt.datetime(2011, 1, 31, 12, 0), dt.datetime(2011, 4, 2)),  # starts after midnight on a last day
        (3, dt.datetime(2011, 1, 31, 0, 0), dt.datetime(2011, 1, 31)),  # one day, midnight
        (4, dt.datetime(2009, 1, 1), dt.datetime(2010, 6, 1)),     # before range
        (5, dt.datetime(2016, 1, 1), dt.datetime(2016, 6, 1)),     # after range
        (6, dt.datetime(2012, 5, 1), dt.datetime(2012, 4, 1)),     # ends before it starts
        (7, dt.datetime(2010, 12, 1), dt.datetime(2011, 1, 1)),    # ends at the first month start
    ]
    df = spark.createDataFrame(offers, "id int, s timestamp_ntz, e timestamp_ntz")
    f, t = dt.date(2011, 1, 1), dt.date(2014, 12, 31)
    got = sorted((r["id"], r["MonthStart"]) for r in months_active(df, "s", "e", f, t).collect())
    want = sorted((i, m) for i, s, e in offers for m in _brute_months(s, e, dt.date(2011, 1, 1), dt.date(2014, 12, 1)))
    assert got == want


def test_active_per_month_counts_ids_once(spark):
    import random

    from promolens.operators.intervals import active_per_month

    rnd = random.Random(3)
    rows = []
    for _ in range(400):
        s = dt.datetime(2009, 1, 1) + dt.timedelta(days=rnd.randrange(2500), hours=rnd.choice([0, 0, 12]))
        rows.append((rnd.choice([1, 2, 3, rnd.randrange(60)]), None if rnd.random() < 0.05 else s,
                     None if rnd.random() < 0.1 else s + dt.timedelta(days=rnd.randrange(-20, 200))))
    df = spark.createDataFrame(rows, "id int, s timestamp_ntz, e timestamp_ntz")
    f, t = dt.date(2011, 1, 1), dt.date(2014, 12, 31)
    want = {r["MonthStart"]: r["n"] for r in months_active(df, "s", "e", f, t).groupBy("MonthStart").agg(F.count_distinct("id").alias("n")).collect()}
    assert {r["MonthStart"]: r["active"] for r in active_per_month(df, "id", "s", "e", f, t).collect()} == want
    assert active_per_month(df.limit(0), "id", "s", "e", f, t).collect() == []
