"""Distinct customers per day, month, store and chain (F1, F2, R1): exact, and from sketches that roll up.

A distinct count cannot be added up: a chain's customers are not the sum of its stores'. The exact way de-duplicates the keys of
every level once more, each level from the one below (``exact_levels``): what is shuffled are keys, never sums. Sketches are a
few kilobytes per store and day, whatever the number of sales; they merge, so every coarser level comes from the stored table
without reading a sale (``roll_up``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.operators.features import month_key

#: Levels from the finest: name and the columns that a row of it has.
LEVELS = {"loja_dia": ["data_venda", "loja_id"], "loja_mes": ["mes", "loja_id"], "rede_mes": ["mes"], "loja": ["loja_id"], "rede": []}
#: A level is made from the de-duplicated keys of this one.
FROM = {"loja_dia": None, "loja_mes": "loja_dia", "rede_mes": "loja_mes", "loja": "loja_mes", "rede": "loja"}
#: log2 of a sketch's registers.
LG_K = 12


def error_bound(lg_k: int = LG_K, sigmas: float = 4.0) -> float:
    """Relative error that an estimate exceeds about once in 16,000 times: the standard error of the sketch is 1.04 / sqrt(2^lg_k)."""
    return sigmas * 1.04 / 2 ** (lg_k / 2)


def _level_row(df: DataFrame, level: str, value) -> DataFrame:
    """(nivel, periodo, loja_id, value): the period is a day, a month or null."""
    period = F.col("data_venda").cast("string") if "data_venda" in LEVELS[level] else (
        F.col("mes") if "mes" in LEVELS[level] else F.lit(None).cast("string"))
    store = F.col("loja_id").cast("bigint") if "loja_id" in LEVELS[level] else F.lit(None).cast("bigint")
    return df.select(F.lit(level).alias("nivel"), period.alias("periodo"), store.alias("loja_id"), value)


def exact_levels(vendas: DataFrame, save) -> DataFrame:
    """(nivel, periodo, loja_id, clientes) of every level, exact; ``save(df, name)`` writes the keys of a level (a level is read
    again by the coarser ones). A null customer is not counted."""
    rows = vendas.where(F.col("cliente_id").isNotNull())
    keys: dict[str, DataFrame] = {}
    out = []
    for level, columns in LEVELS.items():
        below = rows if FROM[level] is None else keys[FROM[level]]
        distinct = below.select(*columns, "cliente_id").distinct()
        if level == "loja_dia":  # the day tells the month: no key of the shuffle
            distinct = distinct.withColumn("mes", month_key())
        keys[level] = save(distinct, f"clientes-{level}")
        out.append(_level_row(keys[level].groupBy(*columns).agg(F.count(F.lit(1)).alias("clientes")), level, "clientes"))
    return reduce(DataFrame.unionByName, out)


def daily_sketches(vendas: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(data_venda, mes, loja_id, esboco): the table to keep. Each task sketches its own sales, only sketches are shuffled."""
    days = vendas.groupBy("data_venda", "loja_id").agg(F.hll_sketch_agg("cliente_id", F.lit(lg_k)).alias("esboco"))
    return days.select("data_venda", month_key().alias("mes"), "loja_id", "esboco")


def roll_up(sketches: DataFrame, columns: list[str]) -> DataFrame:
    """Sketches of a coarser level: ``columns`` and ``esboco``."""
    return sketches.groupBy(*columns).agg(F.hll_union_agg("esboco").alias("esboco"))


def estimated_levels(sketches: DataFrame) -> DataFrame:
    """(nivel, periodo, loja_id, estimativa) of every level from the daily sketches."""
    out = []
    for level, columns in LEVELS.items():
        merged = sketches if level == "loja_dia" else roll_up(sketches, columns)
        out.append(_level_row(merged.withColumn("estimativa", F.hll_sketch_estimate("esboco")), level, "estimativa"))
    return reduce(DataFrame.unionByName, out)


def compare_levels(exact: DataFrame, estimated: DataFrame, bound: float) -> DataFrame:
    """(nivel, periodo, loja_id, clientes, dentro_do_limite): whether the estimate is within ``bound`` of the exact count (and a
    half, as estimates are whole numbers)."""
    e = estimated.select(F.col("nivel").alias("_n"), F.col("periodo").alias("_p"), F.col("loja_id").alias("_l"), "estimativa")
    same = (F.col("nivel") == F.col("_n")) & F.col("periodo").eqNullSafe(F.col("_p")) & F.col("loja_id").eqNullSafe(F.col("_l"))
    within = F.abs(F.col("estimativa") - F.col("clientes")) <= F.lit(bound) * F.col("clientes") + F.lit(0.5)
    return exact.join(e, same, "left").select("nivel", "periodo", "loja_id", "clientes",
                                              F.coalesce(within, F.lit(False)).alias("dentro_do_limite"))
