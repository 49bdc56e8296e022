"""Proposal files: CSV scan with an all-string schema and CSV sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# The cells that a data-frame CSV reader takes as missing.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
           "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_proposals_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a CSV file or folder as text: the header names the columns, every
    column is a string with the usual missing-value cells as NULL, and
    coercion is explicit downstream (no schema inference pass)."""
    header = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
    rows = spark.read.option("header", True).schema(schema).csv(path)
    return rows.select(*[F.when(~F.col(f"`{c}`").isin(*MISSING), F.col(f"`{c}`")).alias(c) for c in header])


def holds_csv(spark: SparkSession, path: str) -> bool:
    """Is ``path`` a CSV file, or a folder with CSV part files?"""
    if path.endswith((".csv", ".csv.gz")):
        return True
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/*.csv*")
    return bool(pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or folder as text, or a Parquet folder."""
    return read_proposals_csv(spark, path) if holds_csv(spark, path) else spark.read.parquet(path)


def as_text(df: DataFrame, keep: tuple[str, ...] = ("ProposalID",)) -> DataFrame:
    """The frame as a CSV reader would deliver it: every column a string."""
    return df.select(*[F.col(c) if c in keep else F.col(c).cast("string").alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str) -> None:
    """Distributed CSV sink: one part file per task, header in each."""
    df.write.mode("overwrite").option("header", True).csv(path)
