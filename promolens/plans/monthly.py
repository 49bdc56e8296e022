"""Parameterised monthly promotion reports.

``line_base`` is the shared, narrow fact of all reports: one row per order
line in the date range with its month, territory, product and category
names and the promotion flag. Run several reports in one job by
writing it once (``reliable_checkpoint(line_base(...))``); each function also works on
a fresh plan, where Catalyst prunes it to the columns the report reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.config import ReportParams
from promolens.functions.dates import in_closed_range, in_half_open_day_range, month_start, year_month_label
from promolens.functions.flags import UNCATEGORIZED, UNSPECIFIED, is_promotion, promo_label
from promolens.operators.intervals import active_per_month
from promolens.operators.topn import rank_filter
from promolens.session import reliable_checkpoint
from promolens.sources.tables import SalesTables


def line_base(t: SalesTables, params: ReportParams) -> DataFrame:
    h = t.sales_order_header.where(in_half_open_day_range(F.col("OrderDate"), params.from_date, params.to_date))
    d = t.sales_order_detail
    st = t.sales_territory.select("TerritoryID", F.col("Name").alias("TerritoryName"))
    p = t.product.select("ProductID", F.col("Name").alias("ProductName"), "ProductNumber",
                         F.col("ProductSubcategoryID").alias("p_sub"))
    psc = t.product_subcategory.select(F.col("ProductSubcategoryID"), F.col("Name").alias("SubcategoryName"),
                                       F.col("ProductCategoryID").alias("psc_cat"))
    pc = t.product_category.select(F.col("ProductCategoryID"), F.col("Name").alias("CategoryName"))
    # Dimension chain first (small relations), then one join with the facts.
    prod = (p.join(psc, F.col("p_sub") == psc.ProductSubcategoryID, "left")
            .join(pc, F.col("psc_cat") == pc.ProductCategoryID, "left")
            .drop("p_sub", "psc_cat"))
    lines = (h.join(d, "SalesOrderID", "inner")
             .join(st, "TerritoryID", "left")
             .join(prod, "ProductID", "inner"))
    return lines.select(
        "SalesOrderID",
        F.col("OrderDate").cast("date").alias("OrderDate"),
        month_start(F.col("OrderDate")).alias("MonthStart"),
        F.year("OrderDate").alias("year"),
        F.month("OrderDate").alias("month"),
        "TerritoryID", "TerritoryName",
        "ProductID", "ProductName", "ProductNumber",
        "ProductCategoryID", "CategoryName", "ProductSubcategoryID", "SubcategoryName",
        "SpecialOfferID",
        is_promotion(F.col("SpecialOfferID"), F.col("UnitPriceDiscount")).alias("IsPromotion"),
        "OrderQty", "UnitPrice", "UnitPriceDiscount",
        (F.col("UnitPrice") * F.col("OrderQty")).alias("GrossBeforeDiscount"),
        (F.col("UnitPrice") * F.col("UnitPriceDiscount") * F.col("OrderQty")).alias("DiscountAmount"),
        F.col("LineTotal").alias("NetRevenue"),
    )


def order_promo_flag(lb: DataFrame) -> DataFrame:
    """Each order in exactly one bucket: 1 if any of its lines is promoted."""
    return lb.groupBy("SalesOrderID").agg(F.max("IsPromotion").alias("OrderHasPromo"))


def promotions_launched(t: SalesTables, params: ReportParams) -> DataFrame:
    so = t.special_offer.where((F.col("SpecialOfferID") != 1)
                               & in_closed_range(F.col("StartDate"), params.from_date, params.to_date))
    return (so.groupBy(F.year("StartDate").alias("year"), F.month("StartDate").alias("month"))
            .agg(F.count(F.lit(1)).alias("num_promotions_launched"))
            .orderBy("year", "month"))


def active_promotions_by_month(t: SalesTables, params: ReportParams) -> DataFrame:
    """Distinct offers active in each month of the range. Months without an
    active offer are absent, as in an inner join against a month list."""
    so = t.special_offer.where(F.col("SpecialOfferID") != 1)
    active = active_per_month(so, "SpecialOfferID", "StartDate", "EndDate", params.from_date, params.to_date)
    return (active.select(F.year("MonthStart").alias("year"), F.month("MonthStart").alias("month"), F.col("active").alias("active_promotions"))
            .orderBy("year", "month"))


def monthly_promo_sales(lb: DataFrame) -> DataFrame:
    ml = lb.groupBy("MonthStart", "IsPromotion").agg(
        F.sum("NetRevenue").alias("Revenue"),
        F.sum("OrderQty").alias("Units"),
        F.sum("DiscountAmount").alias("DiscountTotal"),
        F.sum("GrossBeforeDiscount").alias("GrossBeforeDiscount"))
    # Share of the month total: a window over the aggregate (two rows per month).
    tot = F.sum("Revenue").over(Window.partitionBy("MonthStart"))
    return (ml.select(
        F.year("MonthStart").alias("year"),
        F.month("MonthStart").alias("month"),
        promo_label(F.col("IsPromotion")).alias("promo_flag"),
        "Revenue", "Units",
        (F.nullif(F.col("Revenue"), F.lit(0)) * F.lit(1.0) / F.nullif(F.col("Units"), F.lit(0)))
        .cast(T.DecimalType(18, 2)).alias("ASP"),
        "DiscountTotal",
        (F.col("Revenue") * F.lit(1.0) / F.nullif(tot, F.lit(0))).cast(T.DecimalType(18, 4)).alias("RevenueShare"))
        .orderBy("year", "month", "promo_flag"))


def monthly_promo_orders(lb: DataFrame) -> DataFrame:
    """Orders per month with and without a promoted line, each order
    counted once. An order's month follows from its date, so the month and
    the order flag come out of one aggregation on the order key."""
    per_order = lb.groupBy("SalesOrderID", "MonthStart").agg(F.max("IsPromotion").alias("OrderHasPromo"))
    promo = F.sum(F.when(F.col("OrderHasPromo") == 1, 1).otherwise(0))
    g = per_order.groupBy("MonthStart").agg(
        promo.alias("Orders_Promo"),
        F.sum(F.when(F.col("OrderHasPromo") == 0, 1).otherwise(0)).alias("Orders_NoPromo"),
        F.count(F.lit(1)).alias("Orders_Total"))
    return (g.select(
        year_month_label(F.col("MonthStart")).alias("YearMonth"),
        "Orders_Promo", "Orders_NoPromo", "Orders_Total",
        (F.col("Orders_Promo") * F.lit(1.0) / F.nullif(F.col("Orders_Total"), F.lit(0)))
        .cast(T.DecimalType(5, 2)).alias("Promo_Order_Share"),
        "MonthStart")
        .orderBy("MonthStart").drop("MonthStart"))


def top_groups_by_month(lb: DataFrame, params: ReportParams) -> DataFrame:
    """Top-N (category, subcategory) groups by promoted revenue per month;
    grouping is on the raw names, the default label is applied after."""
    ps = (lb.where(F.col("IsPromotion") == 1)
          .groupBy("MonthStart", "CategoryName", "SubcategoryName")
          .agg(F.sum("NetRevenue").alias("Revenue"), F.sum("OrderQty").alias("Units")))
    ranked = rank_filter(ps, ["MonthStart"], [F.desc("Revenue")], params.top_n)
    return (ranked.select(
        F.year("MonthStart").alias("year"), F.month("MonthStart").alias("month"),
        F.coalesce(F.col("CategoryName"), F.lit(UNCATEGORIZED)).alias("CategoryName"),
        F.coalesce(F.col("SubcategoryName"), F.lit(UNSPECIFIED)).alias("SubcategoryName"),
        "Revenue", "Units", "rnk")
        .orderBy("year", "month", "rnk"))


def monthly_reports(t: SalesTables, params: ReportParams, lb: DataFrame | None = None) -> dict[str, DataFrame]:
    """All monthly reports of one parameter set, sharing one materialised
    ``line_base`` (written once to the shared folder, as the report script's
    temp tables are). ``lb``: one that is stored already."""
    lb = lb if lb is not None else reliable_checkpoint(line_base(t, params))
    return {
        "line_base": lb,
        "order_promo_flag": order_promo_flag(lb),
        "promotions_launched": promotions_launched(t, params),
        "active_promotions_by_month": active_promotions_by_month(t, params),
        "monthly_promo_sales": monthly_promo_sales(lb),
        "monthly_promo_orders": monthly_promo_orders(lb),
        "top_groups_by_month": top_groups_by_month(lb, params),
    }
