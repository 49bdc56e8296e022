"""Ad-hoc promotion reports over the sales star schema.

Each function takes a ``SalesTables`` and returns a lazy DataFrame. Money
is summed as exact decimals. Where a report groups facts by a dimension
attribute, the facts are first aggregated on the join key (a partial
aggregate per product or per order), so the shuffle carries one row per
key instead of one row per line, and the dimension join runs on the
reduced side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.config import ReportParams
from promolens.functions.flags import promo_flag_by_offer
from promolens.operators.topn import top_k_through_joins
from promolens.sources.tables import SalesTables


def promotions_by_year_month(t: SalesTables) -> DataFrame:
    so = t.special_offer
    return (so.groupBy(F.year("StartDate").alias("year"), F.month("StartDate").alias("month"))
            .agg(F.count(F.lit(1)).alias("num_promotions"))
            .orderBy("year", "month"))


def promotions_year_pivot(t: SalesTables, params: ReportParams) -> DataFrame:
    """Launches per calendar month with one column per year; an empty
    (month, year) cell is 0, not NULL."""
    so = t.special_offer
    yr = F.year("StartDate")
    aggs = [F.sum(F.when(yr == y, F.lit(1)).otherwise(F.lit(0))).alias(f"promotions_{y}") for y in params.years]
    return so.groupBy(F.month("StartDate").alias("month")).agg(*aggs).orderBy("month")


def revenue_by_promo_flag(t: SalesTables) -> DataFrame:
    d = t.sales_order_detail
    return (d.groupBy(promo_flag_by_offer(F.col("SpecialOfferID")).alias("promo_flag"))
            .agg(F.sum("LineTotal").alias("total_revenue")))


def _detail_by_product_and_flag(t: SalesTables, flag_col: str = "promo_flag") -> DataFrame:
    """Partial aggregate of the facts on (ProductID, flag): the only
    per-line inputs the profit reports need."""
    d = t.sales_order_detail
    return (d.groupBy("ProductID", promo_flag_by_offer(F.col("SpecialOfferID")).alias(flag_col))
            .agg(F.sum(F.col("UnitPrice") * F.col("OrderQty")).alias("gross"),
                 F.sum("OrderQty").alias("qty"),
                 F.sum("LineTotal").alias("revenue")))


def _profit_parts(t: SalesTables) -> DataFrame:
    # sum((price - cost) * qty) = sum(price * qty) - cost * sum(qty) per product
    pre = _detail_by_product_and_flag(t)
    p = t.product.select("ProductID", "StandardCost")
    return pre.join(p, "ProductID", "inner").select(
        "promo_flag", "revenue", (F.col("gross") - F.col("StandardCost") * F.col("qty")).alias("profit"))


def profit_by_promo_flag(t: SalesTables) -> DataFrame:
    return _profit_parts(t).groupBy("promo_flag").agg(F.sum("profit").alias("total_profit"))


def margin_pct_by_promo_flag(t: SalesTables) -> DataFrame:
    """Profit as a percentage of revenue; a zero revenue gives NULL."""
    g = _profit_parts(t).groupBy("promo_flag").agg(F.sum("profit").alias("p"), F.sum("revenue").alias("r"))
    return g.select(
        "promo_flag",
        (F.col("p").cast("double") * F.lit(100.0).cast("double")
         / F.nullif(F.col("r").cast("double"), F.lit(0.0))).alias("profit_margin_percent"))


def top_promo_products(t: SalesTables, n: int = 10) -> DataFrame:
    """Best-selling product names under promotion (offer id other than the
    no-discount offer); ties on quantity resolved by name."""
    d = t.sales_order_detail.where(F.col("SpecialOfferID") != 1)
    pre = d.groupBy("ProductID").agg(F.sum("OrderQty").alias("q"), F.sum("LineTotal").alias("r"))
    named = pre.join(t.product.select("ProductID", F.col("Name").alias("product_name")), "ProductID", "inner")
    return (named.groupBy("product_name")
            .agg(F.sum("q").alias("total_quantity"), F.sum("r").alias("total_revenue"))
            .orderBy(F.desc("total_quantity"), F.asc("product_name"))
            .limit(n))


def yearly_promo_split(t: SalesTables) -> DataFrame:
    d = t.sales_order_detail
    per_order = d.groupBy("SalesOrderID").agg(
        F.sum(F.when(F.col("SpecialOfferID") == 1, F.col("LineTotal")).otherwise(F.lit(0))).alias("np"),
        F.sum(F.when(F.col("SpecialOfferID") != 1, F.col("LineTotal")).otherwise(F.lit(0))).alias("pr"))
    h = t.sales_order_header.select("SalesOrderID", "OrderDate")
    return (h.join(per_order, "SalesOrderID", "inner")
            .groupBy(F.year("OrderDate").alias("order_year"))
            .agg(F.sum("np").alias("no_promotion_sales"), F.sum("pr").alias("promotion_sales"))
            .orderBy("order_year"))


def product_completeness(t: SalesTables) -> DataFrame:
    p = t.product
    return p.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.sum(F.when(F.col("Weight").isNull() | (F.col("Weight") == 0), 1).otherwise(0)).alias("missing_weight"),
        F.sum(F.when(F.col("Size").isNull(), 1).otherwise(0)).alias("missing_size"),
        F.sum(F.when(F.col("Style").isNull() | (F.col("Style") == "NA"), 1).otherwise(0)).alias("missing_style"),
    )


def _category_of_product(t: SalesTables) -> DataFrame:
    """Inner snowflake chain product -> subcategory -> category."""
    return (t.product.select("ProductID", "ProductSubcategoryID")
            .join(t.product_subcategory.select("ProductSubcategoryID", "ProductCategoryID"),
                  "ProductSubcategoryID", "inner")
            .join(t.product_category.select("ProductCategoryID", F.col("Name").alias("category")),
                  "ProductCategoryID", "inner")
            .select("ProductID", "category"))


def revenue_by_category(t: SalesTables) -> DataFrame:
    pre = t.sales_order_detail.groupBy("ProductID").agg(F.sum("LineTotal").alias("r"))
    return (pre.join(_category_of_product(t), "ProductID", "inner")
            .groupBy("category").agg(F.sum("r").alias("total_revenue"))
            .orderBy(F.desc("total_revenue")))


def line_items_by_category(t: SalesTables) -> DataFrame:
    pre = t.sales_order_detail.groupBy("ProductID").agg(F.count("SalesOrderDetailID").alias("c"))
    return (pre.join(_category_of_product(t), "ProductID", "inner")
            .groupBy("category").agg(F.sum("c").alias("num_line_items"))
            .orderBy(F.desc("num_line_items")))


def top_order_lines(t: SalesTables, n: int = 10) -> DataFrame:
    """The n largest order lines by line total with their order date and
    product name; ties resolved by the line id."""
    d = t.sales_order_detail.select("SalesOrderDetailID", "SalesOrderID", "ProductID", "OrderQty",
                                    "UnitPrice", "LineTotal")

    def enrich(cand: DataFrame) -> DataFrame:
        return (cand.join(t.sales_order_header.select("SalesOrderID", "OrderDate"), "SalesOrderID", "inner")
                .join(t.product.select("ProductID", F.col("Name").alias("product_name")), "ProductID", "inner"))

    top = top_k_through_joins(d, [F.desc("LineTotal"), F.asc("SalesOrderDetailID")], n, enrich)
    return top.select("OrderDate", "product_name", "OrderQty", "UnitPrice", "LineTotal")
