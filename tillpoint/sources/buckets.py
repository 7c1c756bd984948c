"""Co-partitioned tables (A1, A8): written once by a hash of their join key, joined ever after without an exchange.

Two facts that are joined over and over on one key (order lines and orders) are stored in the same number of buckets of that
key, rows sorted inside. A join on the key then reads bucket by bucket: neither side is shuffled, on every run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a bucket of the larger table, about.
BUCKET_BYTES = 256 << 20


@dataclass(frozen=True)
class BucketSpec:
    buckets: int
    keys: tuple[str, ...]


def buckets_for(n_rows: int, row_bytes: int, least: int = 8) -> int:
    """A power of two, so that tables of other sizes can be given a number that divides it."""
    n = least
    while n * BUCKET_BYTES < n_rows * row_bytes:
        n *= 2
    return n


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int, mode: str = "overwrite") -> None:
    """Write ``df`` as the external table ``table`` under ``path``, in ``buckets`` files by a hash of ``keys``, sorted by them.

    Rows are brought to their bucket before the write, so every bucket is one file, not one per task. A null key has a bucket
    like any other value. ``append`` adds files to the buckets of a table that has the same keys and number.
    """
    dealt = df.repartition(buckets, *[F.col(k) for k in keys])
    (dealt.write.mode(mode).format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys)
     .saveAsTable(table))


def bucket_spec(spark: SparkSession, table: str) -> BucketSpec | None:
    """Buckets of a table as the catalog has them, ``None`` without any."""
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "Num Buckets" not in rows:
        return None
    keys = rows["Bucket Columns"].strip("[]").replace("`", "")
    return BucketSpec(int(rows["Num Buckets"]), tuple(k.strip() for k in keys.split(",")))


def join_bucketed(spark: SparkSession, left: str, right: str, columns: dict[str, list[str]], how: str = "inner") -> DataFrame:
    """Join two bucketed tables on their bucket keys, in the order of the keys, reading only ``columns`` of each.

    The tables must have the same number of buckets and as many keys; otherwise Spark would shuffle a side, which is an error
    here. The hint keeps Spark from sending a small side to all tasks instead.
    """
    specs = [bucket_spec(spark, t) for t in (left, right)]
    if None in specs or specs[0].buckets != specs[1].buckets or len(specs[0].keys) != len(specs[1].keys):
        raise ValueError(f"tabelas sem buckets em comum: {left} {specs[0]}, {right} {specs[1]}")
    a, b = (spark.table(t).select(*dict.fromkeys([*s.keys, *columns[t]])) for t, s in zip((left, right), specs))
    on = [a[x] == b[y] for x, y in zip(specs[0].keys, specs[1].keys)]
    return a.join(b.hint("merge"), on, how)
