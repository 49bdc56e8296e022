import dataclasses
import datetime as dt
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from promolens.config import FIXTURE_PARAMS as P
from promolens.plans import monthly, monthly_store
from promolens.sources.tables import SalesTables


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_only_changed_months_are_rewritten(spark):
    t = SalesTables.from_testdata(spark, SF_SMALL)
    path = tempfile.mkdtemp(prefix="promolens-store-")
    full = monthly.line_base(t, P)
    months = {r[0] for r in full.select("MonthStart").distinct().collect()}
    assert set(monthly_store.refresh(t, P, path)) == months
    assert _same(monthly_store.load(t, P, path), full)
    assert monthly_store.refresh(t, P, path) == []

    # one line of one month changes
    one = full.orderBy("OrderDate", "SalesOrderID").first()
    qty = F.when(F.col("SalesOrderID") == one["SalesOrderID"], F.col("OrderQty") + 1).otherwise(F.col("OrderQty"))
    kind = t.sales_order_detail.schema["OrderQty"].dataType
    t2 = dataclasses.replace(t, sales_order_detail=t.sales_order_detail.withColumn("OrderQty", qty.cast(kind)))
    assert monthly_store.refresh(t2, P, path) == [one["MonthStart"]]
    assert _same(monthly_store.load(t2, P, path), monthly.line_base(t2, P))

    # a month loses all its orders; its neighbours stay as they are
    t3 = dataclasses.replace(t2, sales_order_header=t2.sales_order_header.where(
        F.date_trunc("month", "OrderDate").cast("date") != F.lit(one["MonthStart"])))
    assert monthly_store.refresh(t3, P, path) == []
    assert _same(monthly_store.load(t3, P, path), monthly.line_base(t3, P))

    # a dimension name changes: every month
    t4 = dataclasses.replace(t3, sales_territory=t3.sales_territory.withColumn("Name", F.lower("Name")))
    assert set(monthly_store.refresh(t4, P, path)) == months - {one["MonthStart"]}
    assert _same(monthly_store.load(t4, P, path), monthly.line_base(t4, P))


def test_load_prunes_months(spark):
    t = SalesTables.from_testdata(spark, SF_SMALL)
    path = tempfile.mkdtemp(prefix="promolens-store-")
    monthly_store.refresh(t, P, path)
    q = dataclasses.replace(P, from_date=dt.date(1996, 3, 10), to_date=dt.date(1996, 4, 20))
    got = monthly_store.load(t, q, path)
    assert _same(got, monthly.line_base(t, q))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "store_month" in plan
    assert {f.split("store_month=")[1][:7] for f in got.inputFiles()} >= {"1996-03", "1996-04"}
    none = dataclasses.replace(P, from_date=dt.date(1970, 1, 1), to_date=dt.date(1970, 2, 1))
    assert monthly_store.load(t, none, path).count() == 0


def test_ranges_of_months():
    d = dt.date
    assert monthly_store._runs([d(2000, 12, 1), d(2000, 11, 1), d(2001, 1, 1), d(2001, 3, 1)]) == [
        (d(2000, 11, 1), d(2001, 2, 1)), (d(2001, 3, 1), d(2001, 4, 1))]


def test_lines_are_moved_for_the_joins_only(spark):
    """The rows of a month go to its partition from where the last join left them: no further shuffle of wide rows."""
    t = SalesTables.from_testdata(spark, SF_SMALL)
    rows = monthly_store.month_rows(t, P, [dt.date(1996, 3, 1), dt.date(1996, 4, 1)])
    told = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in told and "Rebalance" not in told
    full = monthly.line_base(t, P).where(F.col("MonthStart").between(dt.date(1996, 3, 1), dt.date(1996, 4, 1)))
    assert _same(rows.drop("store_month"), full)
    assert {r[0] for r in rows.select("store_month").distinct().collect()} == {"1996-03", "1996-04"}
