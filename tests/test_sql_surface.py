"""SQL table functions against the DataFrame reports."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from promolens.config import FIXTURE_PARAMS, ReportParams
from promolens.operators.intervals import month_spine
from promolens.plans import monthly, sql_surface
from promolens.sources.tables import SalesTables
from tests.conftest import SF_SMALL

D = dt.date


def rows(df):
    names = sorted(df.columns)
    return sorted(map(str, df.select([F.col(c).cast("string").alias(c) for c in names]).collect()))


@pytest.mark.parametrize("params", [FIXTURE_PARAMS, ReportParams.for_range(D(1996, 2, 14), D(1997, 11, 30), top_n=2)])
def test_reports_equal(spark, params):
    t = SalesTables.from_testdata(spark, SF_SMALL)
    by_sql, by_frame = sql_surface.sql_reports(t, params), monthly.monthly_reports(t, params)
    assert set(by_sql) == set(by_frame)
    for name, df in by_frame.items():
        assert [c.lower() for c in by_sql[name].columns] == [c.lower() for c in df.columns], name
        got = rows(by_sql[name])
        assert got == rows(df) and got, name


def test_months(spark):
    sql_surface.register(SalesTables.from_testdata(spark, SF_SMALL))
    for a, b in ((D(2011, 1, 1), D(2014, 12, 31)), (D(1900, 5, 17), D(2100, 2, 1)), (D(2000, 2, 29), D(2000, 2, 29)), (D(2000, 2, 29), D(2001, 1, 1))):
        got = [r[0] for r in spark.sql("SELECT * FROM promo_months(:a, :b) ORDER BY 1", args={"a": a, "b": b}).collect()]
        assert got == [r[0] for r in month_spine(spark, a, b).orderBy("MonthStart").collect()]
    assert spark.sql("SELECT * FROM promo_months(DATE'2001-01-01', DATE'2000-01-01')").collect() == []


def test_range_reaches_the_scan(spark):
    sql_surface.register(SalesTables.from_testdata(spark, SF_SMALL))
    plan = spark.sql("SELECT * FROM promo_sales(DATE'1996-01-01', DATE'1996-12-31')")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Filter \(.*o_orderdate#\d+ >= 1996-01-01 00:00:00.*o_orderdate#\d+ < 1997-01-01 00:00:00", plan)  # bare column, constants
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    top = spark.sql("SELECT * FROM promo_top_groups(DATE'1996-01-01', DATE'1996-12-31', 3)")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in top


def test_functions_compose(spark):
    sql_surface.register(SalesTables.from_testdata(spark, SF_SMALL))
    out = spark.sql("""SELECT m.MonthStart, count(l.SalesOrderID) AS n FROM promo_months(DATE'1996-01-01', DATE'1996-06-30') m
                       LEFT JOIN promo_lines(DATE'1996-01-01', DATE'1996-06-30') l ON l.MonthStart = m.MonthStart GROUP BY 1""").collect()
    assert len(out) == 6 and sum(r["n"] for r in out) == spark.sql("SELECT * FROM promo_lines(DATE'1996-01-01', DATE'1996-06-30')").count()


def test_tables_of_a_later_call(spark):
    t = SalesTables.from_testdata(spark, SF_SMALL)
    sql_surface.register(t)
    first = sql_surface.report(spark, "promotions_launched", FIXTURE_PARAMS.from_date, FIXTURE_PARAMS.to_date)
    n = first.count()
    t.special_offer.where("SpecialOfferID < 0").createOrReplaceTempView("promo_src_special_offer")
    again = sql_surface.report(spark, "promotions_launched", FIXTURE_PARAMS.from_date, FIXTURE_PARAMS.to_date)
    assert again.collect() == [] and first.count() == n > 0
    assert sql_surface.report(spark, "active_promotions_by_month", FIXTURE_PARAMS.from_date, FIXTURE_PARAMS.to_date).collect() == []
