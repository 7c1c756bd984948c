"""Outliers by z-score in one full scan (D5): moments and a value histogram together, then a second look at two cells.

An outlier lies outside mean ± limit x sd, which are known only after all rows are seen. The first scan therefore counts, beside
the moments, the values of every cell of a fixed grid; cells are cut from the bits of the number (sign, exponent and the first
``BITS`` bits of the mantissa), so their number does not follow the data. Cells wholly beyond a limit are outliers as they
are. Only the cells that hold a limit are read again, through a range filter that reaches the scan.
"""

from __future__ import annotations

import math
import struct

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.functions.numeric import is_missing
from tillpoint.operators.quality import Z_LIMIT, round_even

#: Mantissa bits of a cell: it spans less than 1/2^BITS of its values. At most 2^(12 + BITS) cells, in practice a few thousand.
BITS = 8


def _cell(x: Column) -> Column:
    """Cell of a finite number, ascending with it; 0.0 and -0.0 share one. Scaled by its power of two, a number lies in [1, 2)."""
    size = F.abs(x)
    power = F.floor(F.log2(size))
    # log2 rounds near powers of two: the scaled value says on which side the number is
    scaled = size / F.pow(F.lit(2.0), power)
    power = power + F.when(scaled >= 2.0, 1).when(scaled < 1.0, -1).otherwise(0)
    part = F.floor((size / F.pow(F.lit(2.0), power) - 1.0) * F.lit(2.0 ** BITS))
    cell = ((power + 1100) * F.lit(1 << BITS) + part).cast("long")
    return F.when(x == 0, F.lit(0).cast("long")).when(x > 0, cell).otherwise(-cell)


def cell_range(cell: int) -> tuple[float, float]:
    """Least and greatest number of a cell."""
    if cell == 0:
        return 0.0, 0.0
    power, part = divmod(abs(cell), 1 << BITS)
    low = math.ldexp(1 + part / 2 ** BITS, power - 1100)
    high = math.nextafter(math.ldexp(1 + (part + 1) / 2 ** BITS, power - 1100), 0.0)
    return (low, high) if cell > 0 else (-high, -low)


def histograms(df: DataFrame, columns: list[str]) -> DataFrame:
    """(coluna, cell, n, media, m2) of every column and cell: the one full scan. Rows are summed per task and cell before the
    shuffle; infinite values have a cell each and no moments."""
    values = F.array(*[F.struct(F.lit(c).alias("coluna"), F.when(~is_missing(c, df.schema[c].dataType), F.col(f"`{c}`").cast("double"))
                                .alias("x")) for c in columns])
    rows = df.select(F.inline(values)).where(F.col("x").isNotNull())
    infinite = F.abs("x") == F.lit(float("inf"))
    cell = F.when(infinite, F.signum("x").cast("long") * F.lit(1 << 40)).otherwise(_cell(F.col("x")))
    return rows.groupBy("coluna", cell.alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("media"), (F.var_pop("x") * F.count(F.lit(1))).alias("m2"))


def _moments(cells: list) -> tuple[int, float, float | None]:
    """(n, mean, sample standard deviation) from the cells' own counts, means and squares."""
    n = sum(c.n for c in cells)
    mean = math.fsum(c.n * c.media for c in cells) / n
    m2 = math.fsum(c.m2 + c.n * (c.media - mean) ** 2 for c in cells)
    return n, mean, math.sqrt(m2 / (n - 1)) if n > 1 else None


def outliers(df: DataFrame, columns: list[str], limit: float = Z_LIMIT) -> DataFrame:
    """(coluna, validos, outliers, pct) as ``Audit.acuracia_table``: |x - mean| / sd > ``limit`` over the values that are neither
    NULL nor NaN. Without a spread, or with infinite values, no value is an outlier.

    The cells of all columns reach the driver, a few thousand rows by construction; then one count per limit reads the
    boundary cells only.
    """
    spark = df.sparkSession
    by_column: dict[str, list] = {c: [] for c in columns}
    for r in histograms(df, columns).collect():
        by_column[r.coluna].append(r)
    rows, again = [], []
    for c, cells in by_column.items():
        if not cells:
            rows.append((c, 0, 0))
            continue
        n, beyond = sum(r.n for r in cells), 0
        mean = sd = None
        if all(abs(r.cell) < 1 << 40 for r in cells):
            _, mean, sd = _moments(cells)
        if sd:
            far = lambda x: abs((x - mean) / sd) > limit  # noqa: E731,B023
            for r in cells:
                low, high = cell_range(r.cell)
                if far(low) and far(high) and (low - mean) * (high - mean) > 0:
                    beyond += r.n
                elif far(low) or far(high):  # holds a limit: its rows are looked at one by one
                    x = F.col(f"`{c}`")
                    z = F.abs((x.cast("double") - F.lit(mean)) / F.lit(sd))
                    again.append(df.where((x >= F.lit(low)) & (x <= F.lit(high))).agg(
                        F.lit(c).alias("coluna"), F.count_if(z > F.lit(limit)).alias("mais")))
        rows.append((c, n, beyond))
    out = spark.createDataFrame(rows, "coluna string, validos long, fora long")
    for extra in again:
        out = out.unionByName(extra.select("coluna", F.lit(0).cast("long").alias("validos"), F.col("mais").alias("fora")))
    total = out.groupBy("coluna").agg(F.sum("validos").alias("validos"), F.sum("fora").alias("outliers"))
    pct = round_even(F.col("outliers") / F.nullif(F.col("validos").cast("double"), F.lit(0.0)) * F.lit(100.0))
    return total.select("coluna", "validos", "outliers", pct.alias("pct"))
