"""Duplicate keys of very large tables (D3): a two-pass seen-once / seen-twice filter, then an exact count of candidates.

Counting distinct keys shuffles every key value. Here every key is a position in a very long bit string, by hash:

1. Each task sends, per chunk of the bit string, the four-byte offsets its rows fall on (an offset at most twice). Where the
   chunk's lists meet, the offsets found twice or more are kept: nothing but those can be a duplicate.
2. Only rows whose position was kept are grouped by the key itself, which removes positions that two keys share.

The bit string has 2^32 positions per chunk and a chunk per shuffle partition, so it never lies in one place and has no size at
which it is full: with more keys more positions collide, which adds candidates and changes no count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Positions that a task gathers before it sends them on, the bound of its memory.
HELD = 1 << 22


def _same_key(df: DataFrame, key: str) -> Column:
    """The key in one form for all values that are equal: 0.0 for -0.0, one NaN."""
    c = F.col(f"`{key}`")
    if isinstance(df.schema[key].dataType, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(c), F.lit(float("nan"))).otherwise(c + F.lit(0.0))
    return c


def _by_chunk(chunk: np.ndarray, offset: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(chunk, ascending offsets) with each offset once, or twice if it occurs more often."""
    if not len(chunk):
        return
    order = np.lexsort((offset, chunk))
    chunk, offset = chunk[order], offset[order]
    same = np.r_[False, (chunk[1:] == chunk[:-1]) & (offset[1:] == offset[:-1])]
    third = np.r_[False, same[1:] & same[:-1]]
    chunk, offset = chunk[~third], offset[~third]
    cuts = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]])
    for a, b in zip(cuts, np.r_[cuts[1:], len(chunk)]):
        yield int(chunk[a]), offset[a:b]


def repeated_positions(positions: DataFrame) -> DataFrame:
    """(chunk, offset) of the positions that two or more rows of (chunk int, offset long) fall on."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def send() -> pa.RecordBatch:
            found = list(_by_chunk(*(np.concatenate(a) for a in zip(*held)))) if held else []
            return pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in found], pa.int32()), pa.array([o.astype("<u4").tobytes() for _, o in found], pa.binary())],
                names=["chunk", "offsets"])

        for batch in batches:
            held.append((batch.column("chunk").to_numpy(), batch.column("offset").to_numpy()))
            if sum(len(c) for c, _ in held) >= HELD:
                yield send()
                held.clear()
        yield send()

    def meet(table: pa.Table) -> pa.Table:
        offsets = np.sort(np.concatenate([np.frombuffer(b.as_py(), "<u4") for b in table.column("offsets")]))
        again = np.unique(offsets[1:][offsets[1:] == offsets[:-1]]).astype(np.int64)
        return pa.table({"chunk": pa.array(np.full(len(again), table.column("chunk")[0].as_py()), pa.int32()),
                         "offset": pa.array(again, pa.int64())})

    lists = positions.mapInArrow(gather, "chunk int, offsets binary")
    return lists.groupBy("chunk").applyInArrow(meet, "chunk int, offset long")


def duplicate_keys(df: DataFrame, key: str, chunks: int | None = None) -> DataFrame:
    """(key, n) of every value of ``key``, other than NULL, that two or more rows have."""
    chunks = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.where(F.col(f"`{key}`").isNotNull()).select(_same_key(df, key).alias("valor"))
    rows = rows.withColumn("_h", F.xxhash64("valor"))
    rows = rows.select("valor", F.pmod(F.shiftrightunsigned("_h", 32), F.lit(chunks)).cast("int").alias("chunk"),
                       F.col("_h").bitwiseAND(F.lit((1 << 32) - 1)).alias("offset"))
    again = repeated_positions(rows.select("chunk", "offset")).select(F.col("chunk").alias("_c"), F.col("offset").alias("_o"))
    # the kept positions are small as a rule; how they are joined follows their measured size
    maybe = rows.join(again, (F.col("chunk") == F.col("_c")) & (F.col("offset") == F.col("_o")), "left_semi")
    return maybe.groupBy("valor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("valor").alias(key), "n")


def count_duplicates(df: DataFrame, key: str, chunks: int | None = None) -> DataFrame:
    """One row (coluna, duplicatas): occurrences after the first, NULLs counted as equal, as in ``Audit.unicidade_table``."""
    nulls = df.agg(F.greatest(F.count_if(F.col(f"`{key}`").isNull()) - 1, F.lit(0)).alias("d"))
    extra = duplicate_keys(df, key, chunks).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d"))
    return nulls.unionByName(extra).agg(F.lit(key).alias("coluna"), F.sum("d").cast("bigint").alias("duplicatas"))
