"""Session helpers: the settings every job relies on, applied only where the caller left them unset."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the numeric rules and the plans assume. Existing values (set by a cluster or a caller) win.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # bytes of a task after a shuffle: compressed, and sorts and aggregates over them take about 18 times as much memory
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, app: str = "tillpoint", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the job defaults; ``master``/``shuffle_partitions`` are for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set runtime SQL defaults on an existing session, keeping anything the caller already set."""
    for k, v in DEFAULTS.items():
        if k == "spark.ui.enabled":
            continue  # static; only meaningful at session creation
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (or the context's checkpoint folder).

    On a cluster one of the two must be set. Only in a local session without either is a local folder created and registered with
    ``SparkContext.setCheckpointDir``; ``spark.checkpoint.dir`` itself is a core setting that cannot change at runtime.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    ctx = spark.sparkContext.getCheckpointDir()
    if ctx:
        return ctx
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="tillpoint-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and continue from the written table.

    Cuts the lineage (a lost executor re-reads the table instead of recomputing the inputs) and computes the plan
    exactly once — unlike an RDD checkpoint, which evaluates an unpersisted plan a second time to save it. These tables
    are read a few times at most, so they are written with the smaller codec (zstd).
    """
    import uuid
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
