"""``line_base`` kept by month.

The store is a Parquet table partitioned by month and a manifest with one
row per month: the digest of what the month was built from. ``refresh``
computes the digests of the present tables, rebuilds the months whose digest is new
or different (their order dates reach the scan as ranges) and overwrites just those partitions;
``load`` reads the months that the manifest lists, so a month without rows any more
is left out though its partition stays, and a date range prunes partitions.

A month's digest covers its order headers, their lines and the dimension tables
(one digest for all of these: a changed name rebuilds every month). Digests are
sums of two 64-bit hashes of whole rows, so the order of rows does not matter and
repeated rows count. Lines are moved for the joins only: a month's rows are written where the
last join left them, every task writes its share of each month (one file a task and month, so a month
of a large store has as many files as that join has tasks). The manifest is appended to, after the data: a refresh that
fails half way is done again by the next one. One refresh at a time may run on a store.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.config import ReportParams
from promolens.functions.dates import in_half_open_day_range, month_start
from promolens.plans.monthly import line_base
from promolens.sources.tables import SalesTables

MANIFEST = "run long, month date, n_orders long, n_lines long, digest string"


def _hashes(df: DataFrame, name: str) -> list[Column]:
    cols = [F.col(f"`{c}`") for c in sorted(df.columns)]
    return [F.sum(F.xxhash64(F.lit(seed), *cols).cast("decimal(20,0)")).alias(f"{name}{seed}") for seed in (1, 2)]


def month_digests(t: SalesTables, params: ReportParams) -> DataFrame:
    """(month, n_orders, n_lines, digest) of the months with orders in the range."""
    lines = t.sales_order_detail.groupBy("SalesOrderID").agg(F.count(F.lit(1)).alias("lines"), *_hashes(t.sales_order_detail, "d"))
    h = t.sales_order_header.where(in_half_open_day_range(F.col("OrderDate"), params.from_date, params.to_date))
    seeds = [F.xxhash64(F.lit(s), *[F.col(f"`{c}`") for c in sorted(h.columns)]).alias(f"h{s}") for s in (1, 2)]
    orders = h.select("SalesOrderID", month_start(F.col("OrderDate")).alias("month"), *seeds).join(lines, "SalesOrderID")
    dims = [x for df in (t.sales_territory, t.product, t.product_subcategory, t.product_category)
            for x in df.agg(F.count(F.lit(1)).alias("n"), *_hashes(df, "x")).first()]
    parts = [F.sum(F.col(c).cast("decimal(20,0)") if c[0] == "h" else c).cast("string") for c in ("h1", "h2", "d1", "d2")]
    known = F.lit(",".join(map(str, dims)))
    return orders.groupBy("month").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("lines").alias("n_lines"),
                                       F.sha2(F.concat_ws(",", *parts, known), 256).alias("digest"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _manifest(spark: SparkSession, path: str) -> list:
    """The rows of the last refresh (one per calendar month)."""
    if not _exists(spark, f"{path}/manifest"):
        return []
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    last = rows.agg(F.max("run")).first()[0]
    return rows.where(F.col("run") == F.lit(last)).collect()


def _runs(months: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Months as ranges [first day, first day after the range)."""
    out: list[tuple[dt.date, dt.date]] = []
    for m in sorted(months):
        after = dt.date(m.year + m.month // 12, m.month % 12 + 1, 1)
        out = [*out[:-1], (out[-1][0], after)] if out and out[-1][1] == m else [*out, (m, after)]
    return out


def month_rows(t: SalesTables, params: ReportParams, months: list[dt.date]) -> DataFrame:
    """``line_base`` of the months, with the partition a row goes to."""
    date, wanted = F.col("OrderDate"), F.lit(False)
    for a, b in _runs(months):
        wanted = wanted | ((date >= F.lit(a).cast("timestamp_ntz")) & (date < F.lit(b).cast("timestamp_ntz")))
    part = SalesTables(**{**dict(t.items()), "sales_order_header": t.sales_order_header.where(wanted)})
    return line_base(part, params).withColumn("store_month", F.date_format("MonthStart", "yyyy-MM"))


def refresh(t: SalesTables, params: ReportParams, path: str) -> list[dt.date]:
    """Brings the store at ``path`` up to date; the months it rewrote."""
    spark = t.sales_order_header.sparkSession
    old = _manifest(spark, path)
    known = {r["month"]: r["digest"] for r in old}
    now = month_digests(t, params).collect()  # one row per calendar month
    changed = sorted(r["month"] for r in now if known.get(r["month"]) != r["digest"])
    if changed:
        (month_rows(t, params, changed).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", "zstd").partitionBy("store_month").parquet(f"{path}/lines"))
    if changed or len(now) != len(old):
        run = 1 + max((r["run"] for r in old), default=0)
        spark.createDataFrame([(run, r["month"], r["n_orders"], r["n_lines"], r["digest"]) for r in now], MANIFEST).coalesce(1) \
            .write.mode("append").parquet(f"{path}/manifest")
    return changed


def load(t: SalesTables, params: ReportParams, path: str) -> DataFrame:
    """``line_base`` of a range from the store: only its months are read.
    ``t`` gives the schema. The range must not reach outside the refreshed one."""
    spark = t.sales_order_header.sparkSession
    base = line_base(t, params)
    months = [r["month"] for r in _manifest(spark, path) if dt.date(params.from_date.year, params.from_date.month, 1) <= r["month"] <= params.to_date]
    if not months:
        return base.limit(0)
    stored = spark.read.schema(base.schema.add("store_month", "string")).parquet(f"{path}/lines")
    return (stored.where(F.col("store_month").isin([f"{m:%Y-%m}" for m in months]) & F.col("OrderDate").between(params.from_date, params.to_date))
            .drop("store_month"))
