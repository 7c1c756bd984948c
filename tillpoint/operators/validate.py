"""Validation, cleaning and cut-off filters for the sales fact.

All checks of one table run as a single aggregate job: row count, per-column missing counts and the number of rows
cleaning would drop come out of one ``agg`` over one scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpoint.functions.numeric import is_missing

# Problem messages of the validation report.
MSG_MISSING_COLUMN = "coluna ausente: %s"
MSG_NULLS = "nulos em %s: %d"

# The eleven columns a sales table must have.
REQUIRED_COLUMNS = [
    "data_venda", "loja_id", "produto_id", "categoria", "quantidade", "valor_unitario",
    "valor_total", "custo", "cliente_id", "canal_venda", "regiao",
]

# Columns that must be strictly positive for a row to survive cleaning.
POSITIVE_COLUMNS = ["quantidade", "valor_unitario", "valor_total"]


def missing_columns(df: DataFrame, required=REQUIRED_COLUMNS) -> list[str]:
    """B1: required names absent from the frame, sorted (schema only, no job)."""
    return sorted(set(required) - set(df.columns))


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def keep_predicate(df: DataFrame) -> Column:
    """Quantidade > 0 AND valor_unitario > 0 AND valor_total > 0; NULL and NaN rows fall out of a filter.

    Bare comparisons, so that the filter reaches the Parquet scan; the predicate itself is NULL for NULL values.
    """
    cond = F.lit(True)
    for c in POSITIVE_COLUMNS:
        p = F.col(c) > 0
        if isinstance(_dtype(df, c), (T.DoubleType, T.FloatType)):
            p = p & ~F.isnan(F.col(c))
        cond = cond & p
    return cond


def validation_metrics(df: DataFrame) -> list[Column]:
    """Aggregate expressions: ``linhas``, ``removidas`` (B7) and one ``nulos__<col>`` count per column (B2).
    Usable in ``agg`` or, to validate while writing, in ``DataFrame.observe``."""
    exprs = [F.count(F.lit(1)).alias("linhas")]
    if not missing_columns(df, POSITIVE_COLUMNS):
        exprs.append(F.count_if(~F.coalesce(keep_predicate(df), F.lit(False))).alias("removidas"))
    else:
        exprs.append(F.max(F.lit(None).cast("bigint")).alias("removidas"))
    for c in df.columns:
        exprs.append(F.count_if(is_missing(c, _dtype(df, c))).alias(f"nulos__{c}"))
    return exprs


def validation_aggregate(df: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """One-row frame of :func:`validation_metrics` — one scan, partial + final aggregate, nothing shuffled."""
    return df.agg(*validation_metrics(df))


def report_from_metrics(df: DataFrame, m: dict, required=REQUIRED_COLUMNS) -> dict:
    """B3 as a dict from already computed metrics (e.g. an observed write)."""
    nulls = {c: int(m[f"nulos__{c}"]) for c in df.columns if m.get(f"nulos__{c}")}
    problems = [MSG_MISSING_COLUMN % c for c in missing_columns(df, required)]
    problems += [MSG_NULLS % (c, n) for c, n in nulls.items()]
    return {"valido": not problems, "problemas": problems, "linhas": int(m["linhas"]),
            "colunas": len(df.columns), "nulos_por_coluna": nulls, "removidas": m.get("removidas")}


def schema_report(df: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """One row {valido, problemas, linhas, colunas, nulos_por_coluna (only > 0), removidas}."""
    agg = validation_aggregate(df, required)
    absent = [F.lit(MSG_MISSING_COLUMN % c) for c in missing_columns(df, required)]
    null_msgs = [F.when(F.col(f"nulos__{c}") > 0,
                        F.format_string(MSG_NULLS, F.lit(c), F.col(f"nulos__{c}")))
                 for c in df.columns]
    problems = F.concat(F.array(*absent).cast("array<string>"),
                        F.filter(F.array(*null_msgs), lambda x: x.isNotNull()))
    null_map = F.map_filter(
        F.map_from_arrays(F.array(*[F.lit(c) for c in df.columns]),
                          F.array(*[F.col(f"nulos__{c}") for c in df.columns])),
        lambda k, v: v > 0)
    return agg.select(
        (F.size(problems) == 0).alias("valido"),
        problems.alias("problemas"),
        F.col("linhas"),
        F.lit(len(df.columns)).cast("bigint").alias("colunas"),
        null_map.alias("nulos_por_coluna"),
        F.col("removidas"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """B2 in long form: (coluna, nulos) for every column, from the single aggregate."""
    agg = validation_aggregate(df)
    return agg.unpivot([], [f"nulos__{c}" for c in df.columns], "coluna", "nulos").select(
        F.regexp_replace("coluna", "^nulos__", "").alias("coluna"), F.col("nulos").cast("bigint").alias("nulos"))


def clean_sales(df: DataFrame) -> DataFrame:
    """B5 + B6: keep strictly positive quantity, unit value and total; sale timestamp cut to a DATE."""
    out = df.filter(keep_predicate(df))
    if not isinstance(_dtype(df, "data_venda"), T.DateType):
        out = out.withColumn("data_venda", F.to_date("data_venda"))
    return out


def cut_off(df: DataFrame, ref_date: dt.date | None, column: str = "data_venda") -> DataFrame:
    """Rows on or before ``ref_date`` (inclusive); no-op when ``ref_date`` is None. Pushed to the scan."""
    if ref_date is None:
        return df
    return df.filter(F.col(column) <= F.lit(ref_date))


def only_store(df: DataFrame, loja_id) -> DataFrame:
    """One store; ``None`` means all stores (0 is a valid id)."""
    return df if loja_id is None else df.filter(F.col("loja_id") == F.lit(loja_id))
