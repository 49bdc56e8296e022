"""Helpers shared by the corpus operators: tables in the shared folder,
running numbers over a global order, connected components, Arrow slices."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promolens.session import ensure_checkpoint_dir


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back.

    Cuts the lineage: a lost executor costs the tasks in flight, not the
    steps before the table."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t._staged_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(docs: DataFrame, named: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """``docs`` with its columns called in0, in1, ... but for the ``named`` ones, so that
    no name of the caller's (dots included) meets one of an operator's own."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in named else f"in{k}") for k, c in enumerate(docs.columns)])


def renamed(df: DataFrame, docs: DataFrame, named: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """The columns of ``docs`` from a frame that ``numbered`` began, under their own names."""
    return df.select(*[F.col(c if c in named else f"in{k}").alias(c) for k, c in enumerate(docs.columns)])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_running(df: DataFrame, order: list[str], value: str | None = None, group: list[str] | None = None,
                 out: str = "running", label: str = "running") -> DataFrame:
    """Adds ``out``: the sum of ``value`` (row count when None) over the rows
    of the same ``group`` that come earlier in the order.

    The rows are range-partitioned by (group, order) and written once, so
    each row keeps its range; a range is numbered on its own and shifted by
    the totals of the ranges before it. No task holds more than one range;
    the totals are at most one row per range and group. Rows equal in every
    order column are numbered in any order.
    """
    group = group or []
    n = shuffle_partitions(df.sparkSession)
    keys = [*group, *order]
    v = F.lit(1).cast("long") if value is None else F.col(value).cast("long")
    ranged = staged(df.withColumn("_v", v).repartitionByRange(n, *keys)
                    .withColumn("_range", F.spark_partition_id()), label)
    by_group = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range", *group).agg(F.sum("_v").alias("_t"))
    offsets = totals.withColumn("_o", F.coalesce(F.sum("_t").over(by_group), F.lit(0))).drop("_t")
    local = Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = ranged.withColumn("_l", F.coalesce(F.sum("_v").over(local), F.lit(0)))
    on = [F.col("n._range") == F.col("o._range"), *[F.col(f"n.{g}").eqNullSafe(F.col(f"o.{g}")) for g in group]]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    joined = numbered.alias("n").join(offsets.alias("o"), cond)
    return joined.select(*[F.col(f"n.{c}").alias(c) for c in df.columns],
                         (F.col("o._o") + F.col("n._l")).cast("long").alias(out))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest id reachable from each node that has
    an edge to another node.

    Alternating large and small stars: every round sends each neighbour to
    the smallest one its node knows, with the edge list written to the
    shared folder; nothing but a count and a checksum reaches the driver.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = staged(e, "cc")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
        new = staged(small.select("e.u", "e.v").where("u <> v").distinct(), "cc")
        state = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(e)
        e = new
        if state == before:
            break
        before = state
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def release() -> None:
    """Give freed memory back: workers are reused, and those that wait would
    hold on to what their largest batch took."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``most`` bytes (one
    longer value stays whole); a worker's memory follows the slice."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        lo = held = 0
        for i, s in enumerate(sizes.tolist()):
            if held and held + s > most:
                yield batch.slice(lo, i - lo)
                lo, held = i, 0
            held += s
        yield batch.slice(lo)
    release()


def text_bytes(arr: pa.Array):
    """(bytes of all texts on end, offsets) of a string column; null is empty."""
    import numpy as np

    arr = arr.fill_null("").cast(pa.large_string())
    _, offs, data = arr.buffers()
    off = np.frombuffer(offs, np.int64)[arr.offset: arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0]: off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]
