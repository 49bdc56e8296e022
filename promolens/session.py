"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library depends on for correct results (UTC dates, ANSI
# arithmetic) and for a sane plan (AQE re-plans joins and coalesces
# partitions at run time; skew-join splitting handles hot keys).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Suggested settings for the 100 TB deployment (1000 executors): larger
# scan splits and post-shuffle partitions keep task counts in the low
# hundreds of thousands; AQE still coalesces small stages and splits skew.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "200000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "promolens", driver_memory: str | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; tests and
    the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if driver_memory:  # local mode: the driver JVM is the only executor
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    if master and master.startswith("local"):
        builder = builder.config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    (local tests) do we set one ourselves.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not current and not sc._jsc.sc().getCheckpointDir().isEmpty():
        return sc._jsc.sc().getCheckpointDir().get()
    if current:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(current)
        return current
    if not (fallback or sc.master.startswith("local")):
        raise RuntimeError("spark.checkpoint.dir is not set: point it at shared storage (HDFS, S3, ...)")
    # local mode (tests, a laptop): driver and tasks are one process, a new folder on this machine is shared storage
    path = fallback or tempfile.mkdtemp(prefix="promolens-checkpoints-")
    sc.setCheckpointDir(path)
    return sc._jsc.sc().getCheckpointDir().get()


def reliable_checkpoint(df, spread: bool = False):
    """Write ``df`` once as Parquet into the shared checkpoint folder and read
    it back: the lineage is cut (it survives the loss of the executors that
    computed it) and readers take only the columns they use.

    AQE packs a small result into few files; the steps that read it several
    times (model fitting, scoring) would then run on one core. With
    ``spread``, a table that would be read in fewer partitions than the
    default parallelism is dealt out as it is read; it is not written again."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    parallel = spark.sparkContext.defaultParallelism
    if spread and out.rdd.getNumPartitions() < parallel:
        out = out.repartition(parallel)
    return out
