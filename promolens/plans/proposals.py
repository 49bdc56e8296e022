"""The proposal extract: one row per order line with a clear status,
labelled, with the customer's behaviour metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.functions.flags import accepted_from_status, customer_type
from promolens.sources.tables import SalesTables


def customer_metrics(t: SalesTables, as_of: dt.date | None = None) -> DataFrame:
    """Per customer: order lines (``Purchases``), mean line total (of the
    lines that have one), share of promoted lines and days since the last order at ``as_of``
    (today when None). All statuses count.

    The lines are first reduced per order (count, sum, promoted count),
    so the join with the header carries one row per order; the final
    aggregate is partial + final on the customer key, which keeps a
    customer holding a third of all orders on the map side.
    """
    per_order = t.sales_order_detail.groupBy("SalesOrderID").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("LineTotal").alias("s"), F.count("LineTotal").alias("priced"),
        F.sum(F.when(F.col("SpecialOfferID") != 1, 1).otherwise(0)).alias("promo"))
    h = t.sales_order_header.select("SalesOrderID", "CustomerID", "OrderDate")
    ref = F.lit(as_of) if as_of is not None else F.current_date()
    g = h.join(per_order, "SalesOrderID", "inner").groupBy("CustomerID").agg(
        F.sum("n").alias("Purchases"), F.sum("s").alias("_s"), F.sum("priced").alias("_n"), F.sum("promo").alias("_p"),
        F.max("OrderDate").alias("_last"))
    return g.select(
        "CustomerID", "Purchases",
        (F.col("_s").cast("double") / F.nullif(F.col("_n"), F.lit(0))).alias("AvgOrderValue"),
        (F.col("_p").cast("double") / F.col("Purchases")).alias("PromoResponseRate"),
        F.datediff(ref, F.col("_last").cast("date")).alias("Recency"))


def labelled_lines(t: SalesTables) -> DataFrame:
    """(ProposalID, Accepted) of the extract: lines and order status only."""
    h = t.sales_order_header.where(F.col("Status").isin(4, 5, 6)).select("SalesOrderID", "Status")
    return (t.sales_order_detail.select("SalesOrderID", F.col("SalesOrderDetailID").alias("ProposalID"))
            .join(h, "SalesOrderID", "inner")
            .select("ProposalID", accepted_from_status(F.col("Status")).alias("Accepted")))


def line_values(t: SalesTables) -> DataFrame:
    """(ProposalID, ProposalAmount, Cost) of the extract: lines, status, product cost."""
    h = t.sales_order_header.where(F.col("Status").isin(4, 5, 6)).select("SalesOrderID")
    return (t.sales_order_detail.select("SalesOrderID", "SalesOrderDetailID", "ProductID", "OrderQty", "LineTotal")
            .join(h, "SalesOrderID", "inner").join(t.product.select("ProductID", "StandardCost"), "ProductID", "left")
            .select(F.col("SalesOrderDetailID").alias("ProposalID"), F.col("LineTotal").alias("ProposalAmount"),
                    (F.col("StandardCost") * F.col("OrderQty")).alias("Cost")))


def proposals(t: SalesTables, as_of: dt.date | None = None, extra_columns: bool = False) -> DataFrame:
    """Training extract. ``extra_columns`` also emits the order date and
    the line discount, which the feature step can use when present."""
    h = t.sales_order_header.where(F.col("Status").isin(4, 5, 6)).select(
        "SalesOrderID", "CustomerID", "TerritoryID", "Status", "OrderDate")
    d = t.sales_order_detail.select("SalesOrderID", "SalesOrderDetailID", "ProductID", "OrderQty", "LineTotal",
                                    "UnitPriceDiscount")
    # one row per customer: attributes and metrics, both unique on the key
    cust = t.customer.select("CustomerID", "StoreID").join(customer_metrics(t, as_of), "CustomerID", "full")
    st = t.sales_territory.select("TerritoryID", F.col("Name").alias("Region"))
    prod = (t.product.select("ProductID", "StandardCost", F.col("ProductSubcategoryID").alias("p_sub"))
            .join(t.product_subcategory.select(F.col("ProductSubcategoryID").alias("p_sub"),
                                               F.col("ProductCategoryID").alias("p_cat")), "p_sub", "left")
            .join(t.product_category.select(F.col("ProductCategoryID").alias("p_cat"),
                                            F.col("Name").alias("ProductCategory")), "p_cat", "left")
            .select("ProductID", "StandardCost", "ProductCategory"))
    # What hangs on the customer is joined to the headers, so the lines are
    # never shuffled on a customer key, where one customer may hold a third of
    # them; a hot customer's headers are split by AQE, as the next join needs
    # another key anyway. The lines move on the order and the product key.
    heads = h.join(st, "TerritoryID", "left").join(cust, "CustomerID", "left")
    rows = d.join(heads, "SalesOrderID", "inner").join(prod, "ProductID", "left")
    cols = [
        F.col("SalesOrderDetailID").alias("ProposalID"),
        F.col("LineTotal").alias("ProposalAmount"),
        (F.col("StandardCost") * F.col("OrderQty")).alias("Cost"),
        "Region",
        customer_type(F.col("StoreID")).alias("CustomerType"),
        "ProductCategory",
        accepted_from_status(F.col("Status")).alias("Accepted"),
        "Purchases", "AvgOrderValue", "PromoResponseRate", "Recency",
    ]
    if extra_columns:
        cols += [F.col("OrderDate").alias("OrderDate"), F.col("UnitPriceDiscount")]
    return rows.select(*cols)
