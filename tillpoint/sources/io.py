"""Readers and writers."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAVE_MODES = ("overwrite", "ignore", "errorifexists", "append")


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """A1: sales Parquet; the sale date is read as a timestamp and cut to a DATE during cleaning."""
    df = spark.read.parquet(path)
    if "data_venda" in df.columns and isinstance(df.schema["data_venda"].dataType, T.StringType):
        df = df.withColumn("data_venda", F.to_timestamp("data_venda"))
    return df


def register_sales(df: DataFrame, name: str = "vendas") -> DataFrame:
    """A4: expose the (cleaned) sales frame to SQL as a temporary view — no copy, the plan stays lazy."""
    df.createOrReplaceTempView(name)
    return df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A2/A3: any Parquet table (panel, customer master)."""
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> int:
    """Write one table as Parquet and return its row count, observed during the write (no second pass). The codec
    is zstd, as for the tables of a step.

    ``mode="ignore"`` keeps an existing table untouched, like ``CREATE TABLE IF NOT EXISTS``; the returned count is
    then the one of the existing table.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}")
    if mode == "ignore":
        # an existing table is kept and no job runs, so nothing could be observed: count from Parquet footers
        w = df.write.mode(mode).option("compression", "zstd")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        return df.sparkSession.read.parquet(path).count()
    if partition_by:
        # one partition's rows together, a large partition split, a small one not scattered over many files
        df = df.hint("rebalance", *partition_by)
    obs = Observation(f"rows_{abs(hash(path))}")
    w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["n"])


def stage_done(path: str, spark: SparkSession | None = None) -> bool:
    """True when a stage output at ``path`` was committed (Spark writes ``_SUCCESS`` on commit).

    The check goes through the file system of the path, so a path without a scheme means the default one.
    """
    return path_exists(spark or SparkSession.getActiveSession(), f"{path.rstrip('/')}/_SUCCESS")


def _located(spark: SparkSession, path: str):
    """The path as Hadoop's object, and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _located(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this run has written."""
    p, fs = _located(spark, path)
    fs.delete(p, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Give a written folder its final name; the target must not exist."""
    p, fs = _located(spark, source)
    to, _ = _located(spark, target)
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(p, to):
        raise OSError(f"cannot move {source} to {target}")


def content_key(df: DataFrame, *params) -> str:
    """Key of a stage output: follows the columns, every row (in any order, repeated rows counted) and ``params``."""
    r = df.agg(*content_metrics(df)).first()
    return key_from_metrics(df, r, *params)


def content_metrics(df: DataFrame) -> list:
    """Aggregates from which :func:`key_from_metrics` makes the key, to be computed beside others in one pass."""
    cols = [F.col(f"`{f.name}`") if not isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`").cast("string")
            for f in df.schema.fields]
    # a hash of the native values passes over nulls, so which ones are null is hashed as well
    row = F.xxhash64(*cols, *[c.isNull() for c in cols])
    parts = [row.bitwiseAND(F.lit((1 << 21) - 1)), F.shiftrightunsigned(row, 21).bitwiseAND(F.lit((1 << 21) - 1)),
             F.shiftrightunsigned(row, 42)]  # sums of 22 bits stay in a BIGINT for 2^41 rows
    return [F.count(F.lit(1)).alias("_n"), F.bit_xor(row).alias("_x"),
            *[F.sum(p).alias(f"_s{i}") for i, p in enumerate(parts)]]


def key_from_metrics(df: DataFrame, m, *params) -> str:
    sums = [str(m[k]) for k in ("_n", "_x", "_s0", "_s1", "_s2")]
    text = "|".join([df.schema.simpleString(), *sums, *map(str, params)])
    return hashlib.sha256(text.encode()).hexdigest()[:16]
