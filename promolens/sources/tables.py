"""Sales star schema loader.

``SalesTables`` holds the eight relations the reports read. Production
data is loaded from a catalog or from Parquet folders named after the
tables; ``SalesTables.from_testdata`` maps the driver's TPC-H-like tables
onto the same schema with plain column expressions (no data leaves Spark).
"""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(19, 4)
RATIO = T.DecimalType(4, 2)
LINE_TOTAL = T.DecimalType(38, 6)

TABLE_NAMES = (
    "sales_order_header",
    "sales_order_detail",
    "special_offer",
    "product",
    "product_subcategory",
    "product_category",
    "sales_territory",
    "customer",
)


# Join keys used for bucketing the large tables (co-located joins).
BUCKET_KEYS = {
    "sales_order_header": "SalesOrderID",
    "sales_order_detail": "SalesOrderID",
    "customer": "CustomerID",
    "product": "ProductID",
}


@dataclass(frozen=True)
class SalesTables:
    sales_order_header: DataFrame
    sales_order_detail: DataFrame
    special_offer: DataFrame
    product: DataFrame
    product_subcategory: DataFrame
    product_category: DataFrame
    sales_territory: DataFrame
    customer: DataFrame

    # ------------------------------------------------------------------ loaders
    @staticmethod
    def from_catalog(spark: SparkSession, namespace: str | None = None) -> "SalesTables":
        """Tables registered in the session catalog (``USE <db>`` equivalent)."""
        prefix = f"{namespace}." if namespace else ""
        return SalesTables(**{n: spark.table(prefix + n) for n in TABLE_NAMES})

    @staticmethod
    def from_parquet(spark: SparkSession, root: str) -> "SalesTables":
        """One Parquet folder per table under ``root``."""
        return SalesTables(**{n: spark.read.parquet(os.path.join(root, n)) for n in TABLE_NAMES})

    @staticmethod
    def from_testdata(spark: SparkSession, sf_dir: str) -> "SalesTables":
        return testdata_adapter(spark, sf_dir)

    def register_views(self) -> None:
        """``SELECT … INTO #t`` / ``USE db`` equivalent for SQL users."""
        for f in fields(self):
            getattr(self, f.name).createOrReplaceTempView(f.name)

    def items(self):
        return [(f.name, getattr(self, f.name)) for f in fields(self)]

    def save_bucketed(self, database: str, n_buckets: int, path: str | None = None) -> "SalesTables":
        """Write the tables to ``database``, the large ones bucketed and
        sorted on their join keys (order header and lines on the order id,
        customers on the customer id, products on the product id). Joins
        and per-key aggregations on those keys then read co-located
        buckets instead of shuffling both sides on every report run.
        ``path`` (shared storage) makes the tables external."""
        spark = self.sales_order_header.sparkSession
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, df in self.items():
            w = df.write.mode("overwrite").format("parquet")
            if path:
                w = w.option("path", os.path.join(path, name))
            key = BUCKET_KEYS.get(name)
            if key:
                w = w.bucketBy(n_buckets, key).sortBy(key)
            w.saveAsTable(f"{database}.{name}")
        return SalesTables.from_catalog(spark, database)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def testdata_adapter(spark: SparkSession, sf_dir: str) -> SalesTables:
    """Map the driver test tables onto the sales schema.

    Every relation is derived from the given tables, so its size follows
    the scale factor. The same expressions, written in SQL, form the
    oracle adapter (``promolens.checks.oracle_sql.ADAPTER_CTES``).
    """
    orders = _read(spark, sf_dir, "orders")
    lineitem = _read(spark, sf_dir, "lineitem")
    part = _read(spark, sf_dir, "part")
    cust = _read(spark, sf_dir, "customer")
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")

    # nation has 25 rows by construction of the schema: a bounded broadcast.
    # One row per customer by an aggregate: the optimizer sees that the key is
    # unique and drops this join from queries that never read the territory.
    cust_territory = (
        cust.groupBy("c_custkey").agg(F.min("c_nationkey").alias("c_nationkey"))
        .join(F.broadcast(nation.select("n_nationkey", "n_regionkey")),
              F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey"),
            F.when(F.col("n_nationkey") != 24, F.col("n_regionkey") + 1).cast("int").alias("TerritoryID"),
        )
    )
    header = (
        orders.select("o_orderkey", "o_orderdate", "o_custkey", "o_orderstatus")
        .join(cust_territory, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            F.col("o_orderkey").alias("SalesOrderID"),
            F.col("o_orderdate").alias("OrderDate"),
            F.col("o_custkey").alias("CustomerID"),
            F.col("TerritoryID"),
            F.when(F.col("o_orderstatus") == "F", F.lit(5))
            .when(F.col("o_orderstatus") == "P", F.lit(4))
            .when(F.col("o_orderstatus") == "O", F.lit(1))
            .cast("int").alias("Status"),
        )
    )

    qty = F.col("l_quantity").cast("int")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    # integer cents divided by the quantity (integer division), back to money
    unit_price = (F.try_divide(cents, qty).cast("bigint") * F.lit(0.01).cast(T.DecimalType(3, 2))).cast(MONEY)
    disc = F.col("l_discount").cast(RATIO)
    offer = F.col("l_partkey") + F.col("l_linenumber")
    detail = lineitem.select(
        F.col("l_orderkey").alias("SalesOrderID"),
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("SalesOrderDetailID"),
        F.col("l_partkey").alias("ProductID"),
        # some lines have no offer
        F.when(F.pmod(offer, F.lit(97)) != 5, (F.lit(1) + F.pmod(offer, F.lit(12))).cast("int")).alias("SpecialOfferID"),
        qty.alias("OrderQty"),
        unit_price.alias("UnitPrice"),
        disc.alias("UnitPriceDiscount"),
    ).withColumn(
        "LineTotal",
        (F.col("UnitPrice") * F.col("OrderQty") * (F.lit(1) - F.col("UnitPriceDiscount"))).cast(LINE_TOTAL),
    )

    # One offer per part: id 1 (part 0) is "No Discount". Starts are spread
    # over 1994..2001, some at 12:00 (the EOMONTH edge), some open ended,
    # some ending before they start (bad input the interval logic must skip).
    start_day = F.pmod(F.col("p_partkey") * 7919, F.lit(2922)).cast("int")
    start = (F.lit("1994-01-01").cast("timestamp_ntz")
             + F.make_dt_interval(start_day, F.when(F.pmod("p_partkey", F.lit(10)) == 3, 12).otherwise(0)))
    special_offer = part.select(
        (F.col("p_partkey") + 1).alias("SpecialOfferID"),
        start.alias("StartDate"),
        F.when(F.pmod("p_size", F.lit(9)) == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(start + F.make_dt_interval((F.col("p_size") * 7 - 20).cast("int"))).alias("EndDate"),
    )

    brand_no = F.substring("p_brand", 7, 8).cast("int")
    product = part.select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("Name"),
        F.concat(F.col("p_brand"), F.lit("-"), F.col("p_partkey").cast("string")).alias("ProductNumber"),
        F.col("p_retailprice").cast(MONEY).alias("StandardCost"),
        F.when(F.pmod("p_size", F.lit(7)) == 0, F.lit(None))
        .when(F.pmod("p_size", F.lit(5)) == 0, F.lit(0))
        .otherwise(F.col("p_size")).cast(T.DecimalType(8, 2)).alias("Weight"),
        F.when(F.col("p_size") != 1, F.col("p_size").cast("string")).alias("Size"),
        F.when(F.col("p_type") == "PROMO", F.lit(None).cast("string"))
        .when(F.col("p_type") == "SMALL", F.lit("NA")).otherwise(F.col("p_type")).alias("Style"),
        F.when(brand_no != 25, brand_no).alias("ProductSubcategoryID"),
    )

    sub_ids = part.select(brand_no.alias("n")).where(F.col("n") <= 24).distinct()
    product_subcategory = sub_ids.select(
        F.col("n").alias("ProductSubcategoryID"),
        F.concat(F.lit("Subcategory "), F.col("n").cast("string")).alias("Name"),
        F.when(F.col("n") != 24, F.ceil(F.col("n") / 5)).cast("int").alias("ProductCategoryID"),
    )
    product_category = (
        sub_ids.where(F.col("n") != 24)
        .select(F.ceil(F.col("n") / 5).cast("int").alias("ProductCategoryID")).distinct()
        .select("ProductCategoryID",
                F.concat(F.lit("Category "), F.col("ProductCategoryID").cast("string")).alias("Name"))
    )
    sales_territory = region.select(
        (F.col("r_regionkey") + 1).cast("int").alias("TerritoryID"), F.col("r_name").alias("Name"))
    customer = cust.select(
        F.col("c_custkey").alias("CustomerID"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.col("c_custkey")).alias("StoreID"),
    )
    return SalesTables(
        sales_order_header=header,
        sales_order_detail=detail,
        special_offer=special_offer,
        product=product,
        product_subcategory=product_subcategory,
        product_category=product_category,
        sales_territory=sales_territory,
        customer=customer,
    )


def list_tables(spark: SparkSession, namespace: str | None = None) -> DataFrame:
    """Catalog listing (``SELECT * FROM sys.tables``) as a DataFrame."""
    rows = [(t.name, t.catalog, ",".join(t.namespace or []), t.tableType, bool(t.isTemporary))
            for t in spark.catalog.listTables(namespace)]
    schema = "name string, catalog string, namespace string, table_type string, is_temporary boolean"
    return spark.createDataFrame(rows, schema)


def table_row_counts(tables: SalesTables) -> DataFrame:
    """What is loaded: one row per sales table with its row count.

    Each count is a partial+final aggregate on its own scan; the union of
    eight one-row results is the only thing that meets.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("num_rows")).select(F.lit(name).alias("table_name"), "num_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
