"""Distributed running sums over a global order.

An unpartitioned window (``Window.orderBy(...)``) moves every row into one
task. Here the rows are range-partitioned by the whole order and written
once, so every row keeps its range; a range is summed on its own, and the
totals of the ranges before it (one row per partition, a relation bounded
by the partition count) are broadcast back. The order ends in a key that
tells rows apart, so a value that holds most of the rows is cut like any
other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.session import reliable_checkpoint


def range_partitioned(df: DataFrame, order: list[Column], out: str = "_range", parts: int | None = None) -> DataFrame:
    """``df`` dealt into ranges of ``order`` and written once; ``out`` numbers
    the ranges in order."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return reliable_checkpoint(df.repartitionByRange(n, *order).withColumn(out, F.spark_partition_id()))


def running_sums(df: DataFrame, order: list[Column], values: dict[str, Column], *, prefix: str = "cum_",
                 parts: int | None = None) -> DataFrame:
    """Add ``<prefix><name>`` = inclusive running sum of each value in
    ``order`` (sort expressions such as ``F.desc("score")``; the last ones
    should tell rows apart)."""
    names = list(values)
    ranged = range_partitioned(df.withColumns({f"_v{i}": values[c] for i, c in enumerate(names)}), order, parts=parts)
    out = sums_in_ranges(ranged, order, {c: F.col(f"_v{i}") for i, c in enumerate(names)}, prefix=prefix)
    return out.select(*df.columns, *[f"{prefix}{c}" for c in names])


def sums_in_ranges(ranged: DataFrame, order: list[Column], values: dict[str, Column], *, prefix: str = "cum_") -> DataFrame:
    """``running_sums`` of rows that are dealt into ranges already (column
    ``_range``); any rows may have been filtered out since."""
    names = list(values)
    base = ranged.withColumns({f"_w{i}": values[c] for i, c in enumerate(names)})
    totals = base.groupBy("_range").agg(*[F.sum(f"_w{i}").alias(f"_t{i}") for i in range(len(names))])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = totals.select("_range", *[F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_o{i}")
                                        for i in range(len(names))])
    local = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = base.withColumns({f"_s{i}": F.sum(f"_w{i}").over(local) for i in range(len(names))})
    out = summed.join(F.broadcast(offsets), "_range")  # at most one row per partition
    return out.select(*ranged.columns, *[(F.col(f"_s{i}") + F.col(f"_o{i}")).alias(f"{prefix}{c}") for i, c in enumerate(names)])
