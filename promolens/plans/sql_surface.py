"""The monthly reports as SQL table functions with parameters.

``register`` makes the sales tables views of the session (``promo_src_*``) and
creates temporary table functions over them, so that a report is a statement:

    SELECT * FROM promo_sales(DATE'2011-01-01', DATE'2014-12-31')

The arguments are folded into the plan, so the date range reaches the scan and
the top-n limit the window, as in the DataFrame reports; the rows are the same
ones (``tests/test_sql_surface.py``). Functions call functions: all reports on
lines read ``promo_lines``, the months come from ``promo_months``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from promolens.config import ReportParams
from promolens.functions.flags import NO_DISCOUNT_OFFER_ID, NO_PROMOTION, PROMOTION, UNCATEGORIZED, UNSPECIFIED
from promolens.sources.tables import SalesTables

PREFIX = "promo_src_"
_RANGE = "from_date DATE, to_date DATE"

# name -> (parameters, body)
FUNCTIONS: dict[str, tuple[str, str]] = {
    # one recursion level a year, so the range may be as long as the calendar
    "promo_months": (_RANGE, """
        WITH RECURSIVE years(y) MAX RECURSION LEVEL 9999 AS (
            SELECT year(from_date) UNION ALL SELECT y + 1 FROM years WHERE y < year(to_date))
        SELECT make_date(y, m, 1) AS MonthStart FROM years LATERAL VIEW explode(sequence(1, 12)) AS m
        WHERE make_date(y, m, 1) >= trunc(from_date, 'MM') AND make_date(y, m, 1) <= to_date"""),
    "promo_lines": (_RANGE, f"""
        WITH products AS (
            FROM {PREFIX}product
            |> SELECT ProductID, Name AS ProductName, ProductNumber, ProductSubcategoryID AS own_subcategory
            |> LEFT JOIN (SELECT ProductSubcategoryID, Name AS SubcategoryName, ProductCategoryID AS own_category FROM {PREFIX}product_subcategory)
                 ON own_subcategory = ProductSubcategoryID
            |> LEFT JOIN (SELECT ProductCategoryID, Name AS CategoryName FROM {PREFIX}product_category) ON own_category = ProductCategoryID)
        FROM {PREFIX}sales_order_header
        |> WHERE OrderDate >= CAST(from_date AS TIMESTAMP_NTZ) AND OrderDate < CAST(date_add(to_date, 1) AS TIMESTAMP_NTZ)
        |> JOIN {PREFIX}sales_order_detail USING (SalesOrderID)
        |> LEFT JOIN (SELECT TerritoryID, Name AS TerritoryName FROM {PREFIX}sales_territory) USING (TerritoryID)
        |> JOIN products USING (ProductID)
        |> SELECT SalesOrderID, CAST(OrderDate AS DATE) AS OrderDate, trunc(CAST(OrderDate AS DATE), 'MM') AS MonthStart,
                  year(OrderDate) AS year, month(OrderDate) AS month, TerritoryID, TerritoryName, ProductID, ProductName, ProductNumber,
                  ProductCategoryID, CategoryName, ProductSubcategoryID, SubcategoryName, SpecialOfferID,
                  CASE WHEN SpecialOfferID = {NO_DISCOUNT_OFFER_ID} OR UnitPriceDiscount = 0 THEN 0 ELSE 1 END AS IsPromotion,
                  OrderQty, UnitPrice, UnitPriceDiscount, UnitPrice * OrderQty AS GrossBeforeDiscount,
                  UnitPrice * UnitPriceDiscount * OrderQty AS DiscountAmount, LineTotal AS NetRevenue"""),
    "promo_order_flags": (_RANGE, """
        FROM promo_lines(from_date, to_date) |> AGGREGATE max(IsPromotion) AS OrderHasPromo GROUP BY SalesOrderID"""),
    "promo_launched": (_RANGE, f"""
        FROM {PREFIX}special_offer
        |> WHERE SpecialOfferID <> {NO_DISCOUNT_OFFER_ID}
             AND StartDate >= CAST(from_date AS TIMESTAMP_NTZ) AND StartDate <= CAST(to_date AS TIMESTAMP_NTZ)
        |> AGGREGATE count(*) AS num_promotions_launched GROUP BY year(StartDate) AS year, month(StartDate) AS month"""),
    # month ranges of an offer merged, +1 at the first month, -1 after the last, running sum over the months
    "promo_active": (_RANGE, f"""
        WITH ranges AS (
            SELECT DISTINCT SpecialOfferID AS id,
                   greatest(12 * year(StartDate) + month(StartDate) - 1
                            + CAST(StartDate > CAST(last_day(CAST(StartDate AS DATE)) AS TIMESTAMP_NTZ) AS INT),
                            12 * year(from_date) + month(from_date) - 1) AS lo,
                   least(coalesce(12 * year(EndDate) + month(EndDate) - 1, 12 * year(to_date) + month(to_date) - 1),
                         12 * year(to_date) + month(to_date) - 1) AS hi
            FROM {PREFIX}special_offer WHERE SpecialOfferID <> {NO_DISCOUNT_OFFER_ID} AND StartDate IS NOT NULL),
        opened AS (
            SELECT id, lo, hi, CASE WHEN lo <= max(hi) OVER (PARTITION BY id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                                    THEN 0 ELSE 1 END AS opens
            FROM ranges WHERE lo <= hi),
        numbered AS (
            SELECT id, lo, hi, sum(opens) OVER (PARTITION BY id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS part FROM opened),
        merged AS (SELECT min(lo) AS lo, max(hi) + 1 AS past FROM numbered GROUP BY id, part),
        events AS (SELECT k, sum(d) AS d FROM merged LATERAL VIEW stack(2, lo, 1, past, -1) AS k, d GROUP BY k)
        SELECT year(MonthStart) AS year, month(MonthStart) AS month, active AS active_promotions
        FROM (SELECT MonthStart, sum(coalesce(d, 0)) OVER (ORDER BY MonthStart ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS active
              FROM promo_months(from_date, to_date) LEFT JOIN events ON k = 12 * year(MonthStart) + month(MonthStart) - 1)
        WHERE active > 0"""),
    "promo_sales": (_RANGE, f"""
        FROM promo_lines(from_date, to_date)
        |> AGGREGATE sum(NetRevenue) AS Revenue, sum(OrderQty) AS Units, sum(DiscountAmount) AS DiscountTotal GROUP BY MonthStart, IsPromotion
        |> EXTEND sum(Revenue) OVER (PARTITION BY MonthStart) AS MonthRevenue
        |> SELECT year(MonthStart) AS year, month(MonthStart) AS month,
                  CASE WHEN IsPromotion = 1 THEN '{PROMOTION}' ELSE '{NO_PROMOTION}' END AS promo_flag, Revenue, Units,
                  CAST(nullif(Revenue, 0) * 1.0D / nullif(Units, 0) AS DECIMAL(18, 2)) AS ASP, DiscountTotal,
                  CAST(Revenue * 1.0D / nullif(MonthRevenue, 0) AS DECIMAL(18, 4)) AS RevenueShare"""),
    "promo_orders": (_RANGE, """
        FROM promo_lines(from_date, to_date)
        |> AGGREGATE max(IsPromotion) AS promoted GROUP BY SalesOrderID, MonthStart
        |> AGGREGATE count_if(promoted = 1) AS Orders_Promo, count_if(promoted = 0) AS Orders_NoPromo, count(*) AS Orders_Total GROUP BY MonthStart
        |> SELECT date_format(MonthStart, 'yyyy-MM') AS YearMonth, Orders_Promo, Orders_NoPromo, Orders_Total,
                  CAST(Orders_Promo * 1.0D / nullif(Orders_Total, 0) AS DECIMAL(5, 2)) AS Promo_Order_Share"""),
    "promo_top_groups": (_RANGE + ", top_n INT", f"""
        FROM promo_lines(from_date, to_date)
        |> WHERE IsPromotion = 1
        |> AGGREGATE sum(NetRevenue) AS Revenue, sum(OrderQty) AS Units GROUP BY MonthStart, CategoryName, SubcategoryName
        |> EXTEND rank() OVER (PARTITION BY MonthStart ORDER BY Revenue DESC) AS rnk
        |> WHERE rnk <= top_n
        |> SELECT year(MonthStart) AS year, month(MonthStart) AS month, coalesce(CategoryName, '{UNCATEGORIZED}') AS CategoryName,
                  coalesce(SubcategoryName, '{UNSPECIFIED}') AS SubcategoryName, Revenue, Units, rnk"""),
}

# report of ``monthly.monthly_reports`` -> its function
REPORTS = {"line_base": "promo_lines", "order_promo_flag": "promo_order_flags", "promotions_launched": "promo_launched",
           "active_promotions_by_month": "promo_active", "monthly_promo_sales": "promo_sales", "monthly_promo_orders": "promo_orders",
           "top_groups_by_month": "promo_top_groups"}


def register(t: SalesTables) -> None:
    """Views of the tables and all functions, in the session of the tables. A
    later call with other tables replaces them; frames made before keep theirs."""
    spark = t.sales_order_header.sparkSession
    for name, df in t.items():
        df.createOrReplaceTempView(f"{PREFIX}{name}")
    for name, (parameters, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE RETURN {body}")


def report(spark: SparkSession, name: str, from_date: dt.date, to_date: dt.date, top_n: int | None = None) -> DataFrame:
    """A report of ``REPORTS`` by its registered function."""
    more = ", :top_n" if name == "top_groups_by_month" else ""
    args = {"a": from_date, "b": to_date, **({"top_n": top_n} if more else {})}
    return spark.sql(f"SELECT * FROM {REPORTS[name]}(:a, :b{more})", args=args)


def sql_reports(t: SalesTables, params: ReportParams) -> dict[str, DataFrame]:
    """All monthly reports of one parameter set, by SQL."""
    register(t)
    spark = t.sales_order_header.sparkSession
    return {name: report(spark, name, params.from_date, params.to_date, params.top_n) for name in REPORTS}
