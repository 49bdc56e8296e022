from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from promolens.sources.tables import SalesTables, list_tables, table_row_counts


def test_adapter_keys_and_listing(spark):
    mid = SalesTables.from_testdata(spark, SF_MID).sales_order_detail
    assert mid.select("SalesOrderDetailID").distinct().count() == mid.count()  # unique line id
    t = SalesTables.from_testdata(spark, SF_SMALL)
    counts = {r["table_name"]: r["num_rows"] for r in table_row_counts(t).collect()}
    assert counts["sales_order_detail"] == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert counts["product_category"] == 5 and counts["product_subcategory"] == 24
    t.register_views()
    names = {r["name"] for r in list_tables(spark).collect()}
    assert {"sales_order_header", "special_offer", "product"} <= names
    assert spark.sql("SELECT count(*) FROM special_offer WHERE SpecialOfferID = 1").first()[0] == 1


def test_adapter_money_is_exact(spark):
    t = SalesTables.from_testdata(spark, SF_SMALL)
    d = t.sales_order_detail
    bad = d.where(F.col("LineTotal") != F.col("UnitPrice") * F.col("OrderQty") * (1 - F.col("UnitPriceDiscount")))
    assert bad.count() == 0
    assert dict(d.dtypes)["UnitPrice"] == "decimal(19,4)"


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    t = SalesTables.from_testdata(spark, SF_SMALL)
    b = t.save_bucketed("promolens_test_db", 4, path=str(tmp_path / "wh"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # behave as with large tables
    try:
        q = (b.sales_order_header.join(b.sales_order_detail, "SalesOrderID")
             .groupBy("SalesOrderID").agg(F.count("*").alias("n")))
        plan = q._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    assert q.count() == t.sales_order_header.join(t.sales_order_detail, "SalesOrderID").select("SalesOrderID").distinct().count()
