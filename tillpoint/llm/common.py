"""Small helpers that several operators share."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: The six ASCII white-space characters that separate words: space, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; pure ASCII strings take the fast path of ``lower``."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def whole(text: str) -> Column:
    """The text column with null read as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def hash128(col: Column) -> list[Column]:
    """Two independent 64-bit hashes of a string; together they identify it."""
    return [F.xxhash64(F.lit(1), col), F.xxhash64(F.lit(2), col)]


def content_key(text: str) -> list[Column]:
    """What tells apart rows that share an id: null texts differ from empty ones."""
    h = hash128(whole(text))
    return [F.when(F.col(text).isNull(), F.lit(0).cast("long")).otherwise(h[0]), h[1]]


def prepare(spark: SparkSession) -> None:
    """Make a session ready for the Python parts of the operators.

    Arrow batches get few rows, so that very long texts stay small in memory (a value set by the caller wins), and the
    package is sent along with the tasks once per application, as the executors may not have it installed.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) in (None, "", "10000"):
        spark.conf.set(key, "512")
    context = spark.sparkContext
    if not getattr(context, "_tillpoint_sent", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tillpoint-code-"), "tillpoint_code"), "zip",
                                      os.path.dirname(package), os.path.basename(package))
        context.addPyFile(archive)
        context._tillpoint_sent = True
