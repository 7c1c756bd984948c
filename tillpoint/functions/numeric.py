"""Numeric rules shared by every operator so that results are reproducible value by value.

* Money is summed exactly, as integer **cents in BIGINT** (order independent, fixed-width and codegen-friendly;
  a DECIMAL(28,2) sum buffer would be a BigDecimal object per group), and turned into DOUBLE with ``cents / 100``
  before any division. For totals below 2^53 cents this is the correctly rounded double of the exact decimal sum,
  i.e. the same value a DECIMAL sum cast to DOUBLE gives. BIGINT overflow raises under ANSI mode. This holds for
  integers and for DECIMAL columns with at most two decimals; a column with more decimals is summed as a DECIMAL of its
  own scale, a DOUBLE or FLOAT column as DECIMAL(28,8), so that no row is rounded to a cent before the sum.
* Rounding to ``n`` places is ``round(x * 10^n, 0) / 10^n``: the product is an IEEE double and Spark rounds it
  half away from zero, which is the classic SQL ``ROUND(double, n)`` behaviour (``1.005`` stays ``1.0``);
  Spark's ``round(x, n)`` on a double rounds the decimal *string* instead and would give ``1.01``.
* Every divisor goes through ``nullif(d, 0)``: a zero denominator yields NULL rather than an ANSI error.
* "Missing" means NULL, or NaN for floating columns (pandas ``isnull`` semantics).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Cast an amount to DECIMAL(18,2) so that sums are exact."""
    return _col(c).cast(MONEY)


def cents(c, df: DataFrame | None = None) -> Column:
    """Amount in cents. With ``df`` the type of its column ``c`` decides: BIGINT when whole cents hold it, else an exact
    DECIMAL with the digits below the cent. Without ``df``: BIGINT, half-up at the second decimal."""
    kind = df.schema[c].dataType if df is not None else None
    if isinstance(kind, T.DecimalType) and kind.scale > 2:
        return F.col(c) * F.lit(100)
    if isinstance(kind, T.DecimalType) and kind.precision > 15:  # more digits than a double holds
        return (F.col(c) * F.lit(100)).cast("bigint")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.col(c).cast(T.DecimalType(28, 8)) * F.lit(100)
    return F.round(_col(c).cast("double") * F.lit(100.0), 0).cast("bigint")


def from_cents(c) -> Column:
    """Cents back to a DOUBLE amount."""
    return _col(c).cast("double") / F.lit(100.0)


def to_double(c) -> Column:
    return _col(c).cast("double")


def safe_div(num, den) -> Column:
    """``num / nullif(den, 0)`` in DOUBLE arithmetic."""
    return to_double(num) / F.nullif(to_double(den), F.lit(0.0))


def round_to(c, places: int = 2) -> Column:
    """SQL ``ROUND(double, places)``: scale, round half away from zero, unscale."""
    scale = float(10 ** places)
    return F.round(to_double(c) * F.lit(scale), 0) / F.lit(scale)


def is_missing(c, dtype: T.DataType | None = None) -> Column:
    """NULL, or NaN when the column is floating point."""
    col = _col(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()
