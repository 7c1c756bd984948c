"""The eight retail feature tables (F1–F8) and the builder that derives them from one cleaned sales frame.

Scale notes
-----------
* Each table is one grouped aggregate (partial aggregation before the shuffle) over the sales fact; windows only
  ever run over already-aggregated rows (store × day, store × month, …), so a hot store never sends raw sales rows
  to a single task.
* Money is summed exactly (BIGINT cents, or a DECIMAL for finer amounts) and turned into DOUBLE afterwards (see :mod:`tillpoint.functions.numeric`).
* Per-table ``ORDER BY`` of the reference is presentation only; tables are returned unsorted and
  :func:`presentation_order` gives the ordering when a caller wants it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.functions.numeric import cents, from_cents, round_to, safe_div
from tillpoint.operators.validate import cut_off

# Weekday labels, Sunday = 0 … Saturday = 6.
WEEKDAY_NAMES = ["Domingo", "Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado"]

TOP_K_PRODUCTS = 5
MOVING_WINDOW_ROWS = 7

FEATURE_NAMES = [
    "ticket_medio", "frequencia_cliente", "share_categoria", "crescimento_mom",
    "recencia_cliente", "tendencia_7d", "sazonalidade_dia", "top_produtos",
]

# Presentation order of each table (the reference's ORDER BY).
ORDERING = {
    "ticket_medio": ["data_venda", "loja_id"],
    "frequencia_cliente": ["cliente_id", "mes"],
    "share_categoria": ["loja_id", "-share_pct"],
    "crescimento_mom": ["loja_id", "mes"],
    "recencia_cliente": ["dias_desde_ultima"],
    "tendencia_7d": ["data_venda", "loja_id"],
    "sazonalidade_dia": ["loja_id", "dia_semana"],
    "top_produtos": ["loja_id", "mes", "rank"],
}


def month_key(c="data_venda"):
    """``YYYY-MM`` month key (string), as the reference's ``STRFTIME(d, '%Y-%m')``."""
    return F.date_format(F.col(c), "yyyy-MM")


def weekday0(c="data_venda"):
    """Weekday with Sunday = 0 (Spark's ``dayofweek`` starts at Sunday = 1)."""
    return (F.dayofweek(F.col(c)) - 1).cast("bigint")


def with_distinct(rows: DataFrame, keys: list[str], sums: dict, value: str, name: str) -> DataFrame:
    """Per ``keys`` the aggregates ``sums`` (name: (function, column)) and the number of distinct ``value`` as ``name``.

    A distinct count beside sums makes Spark shuffle every sum buffer by (keys, value). Here only keys and values are, each
    pair once per task; the pairs left then count one each in a single aggregate with the rows themselves. NULL is a key
    like any other and no value.
    """
    own = rows.select(*keys, *[c.alias(n) for n, (_, c) in sums.items()], F.lit(0).cast("bigint").alias(name))
    pairs = rows.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    pairs = pairs.select(*keys, *[F.lit(None).cast(own.schema[n].dataType).alias(n) for n in sums],
                         F.lit(1).cast("bigint").alias(name))
    return own.unionByName(pairs).groupBy(*keys).agg(*[f(n).alias(n) for n, (f, _) in sums.items()], F.sum(name).alias(name))


def daily_store(vendas: DataFrame) -> DataFrame:
    """Shared (day, store) aggregate: cent revenue, sale count, distinct customers. F1, F4, F6 and F7 derive from it
    (cent sums roll up exactly)."""
    sums = {"_r": (F.sum, cents("valor_total", vendas)), "n_vendas": (F.sum, F.lit(1).cast("bigint"))}
    return with_distinct(vendas, ["data_venda", "loja_id"], sums, "cliente_id", "clientes_unicos")


def daily_sums(vendas: DataFrame) -> DataFrame:
    """(day, store) revenue and sale count: what F6 needs."""
    return vendas.groupBy("data_venda", "loja_id").agg(F.sum(cents("valor_total", vendas)).alias("_r"),
                                                       F.count(F.lit(1)).alias("n_vendas"))


def customer_month(vendas: DataFrame) -> DataFrame:
    """Shared (customer, month) aggregate: purchases, cent spend, distinct stores and last purchase date.
    F2 and F5 derive from it."""
    sums = {"compras": (F.sum, F.lit(1).cast("bigint")), "_g": (F.sum, cents("valor_total", vendas)),
            "_last": (F.max, F.col("data_venda"))}
    return with_distinct(vendas.withColumn("mes", month_key()), ["cliente_id", "mes"], sums, "loja_id", "lojas_visitadas")


def ticket_medio(vendas: DataFrame, ref_date: dt.date | None = None, daily: DataFrame | None = None) -> DataFrame:
    """per (day, store) revenue, sale count, mean ticket (2 dp) and distinct customers."""
    agg = daily if daily is not None else daily_store(cut_off(vendas, ref_date))
    if daily is not None and ref_date is not None:
        agg = cut_off(agg, ref_date)
    return agg.select(
        "data_venda", "loja_id",
        from_cents("_r").alias("receita_total"),
        F.col("n_vendas").cast("bigint").alias("n_vendas"),
        round_to(safe_div(from_cents("_r"), "n_vendas"), 2).alias("ticket_medio"),
        F.col("clientes_unicos").cast("bigint").alias("clientes_unicos"))


def frequencia_cliente(vendas: DataFrame, ref_date: dt.date | None = None,
                       by_month: DataFrame | None = None) -> DataFrame:
    """per (customer, month) purchases, spend (2 dp) and distinct stores visited."""
    if by_month is not None and ref_date is None:
        agg = by_month
    else:
        agg = customer_month(cut_off(vendas, ref_date))
    return agg.select(
        "cliente_id", "mes",
        F.col("compras").cast("bigint").alias("compras"),
        round_to(from_cents("_g"), 2).alias("gasto_total"),
        F.col("lojas_visitadas").cast("bigint").alias("lojas_visitadas"))


def share_categoria(vendas: DataFrame, ref_date: dt.date | None = None) -> DataFrame:
    """category share of store revenue (%), category revenue and margin.

    The store total is a window sum over the (store, category) aggregate — no self-join and a single scan; the cut-off
    applies to both sides because it is applied once, before the aggregate.
    """
    agg = (cut_off(vendas, ref_date)
           .groupBy("loja_id", "categoria")
           .agg(F.sum(cents("valor_total", vendas)).alias("_r"), F.sum(cents("custo", vendas)).alias("_c")))
    return category_shares(agg)


def category_shares(agg: DataFrame) -> DataFrame:
    """F3 from the sums (_r, _c) of every store and category."""
    total = F.sum("_r").over(Window.partitionBy("loja_id"))
    return agg.select(
        "loja_id", "categoria",
        round_to(safe_div(from_cents("_r"), from_cents(total)) * F.lit(100.0), 2).alias("share_pct"),
        round_to(from_cents("_r"), 2).alias("receita_categoria"),
        round_to(from_cents(F.col("_r") - F.col("_c")), 2).alias("margem_categoria"))


def crescimento_mom(vendas: DataFrame, daily: DataFrame | None = None) -> DataFrame:
    """monthly store revenue and % change against the previous existing month row (gaps are not filled)."""
    if daily is not None:
        m = daily.groupBy("loja_id", month_key().alias("mes")).agg(F.sum("_r").alias("_r"))
    else:
        m = vendas.groupBy("loja_id", month_key().alias("mes")).agg(F.sum(cents("valor_total", vendas)).alias("_r"))
    prev = F.lag("_r").over(Window.partitionBy("loja_id").orderBy("mes"))
    return m.select(
        "loja_id", "mes",
        from_cents("_r").alias("receita"),
        round_to(safe_div(from_cents(F.col("_r") - prev), from_cents(prev)) * F.lit(100.0), 2)
        .alias("crescimento_mom_pct"))


def recencia_cliente(vendas: DataFrame, ref_date: dt.date, by_month: DataFrame | None = None) -> DataFrame:
    """last purchase date per customer and whole days from it to ``ref_date`` (may be negative)."""
    if by_month is not None:
        agg = by_month.groupBy("cliente_id").agg(F.max("_last").alias("ultima_compra"))
    else:
        agg = vendas.groupBy("cliente_id").agg(F.max("data_venda").alias("ultima_compra"))
    return agg.select(
        "cliente_id", "ultima_compra",
        F.date_diff(F.lit(ref_date), F.col("ultima_compra")).cast("bigint").alias("dias_desde_ultima"))


def tendencia_7d(vendas: DataFrame, daily: DataFrame | None = None) -> DataFrame:
    """daily store revenue, its 7-row moving average (2 dp) and the % deviation from the unrounded average.

    The frame is 7 *rows* (not calendar days) with partial frames at the start; the average is the exact cent
    frame sum divided by the frame row count, computed once and reused.
    """
    return moving_trend(moving_sums(daily if daily is not None else daily_sums(vendas)))


def moving_sums(daily: DataFrame) -> DataFrame:
    """(data_venda, loja_id, _r, _s, _k): revenue of a day and store, sum and number of the rows of its frame, for F6."""
    w = Window.partitionBy("loja_id").orderBy("data_venda").rowsBetween(-(MOVING_WINDOW_ROWS - 1), 0)
    return daily.select("data_venda", "loja_id", "_r", F.sum("_r").over(w).alias("_s"), F.count(F.lit(1)).over(w).alias("_k"))


def moving_trend(sums: DataFrame, *more: str) -> DataFrame:
    """F6 from :func:`moving_sums`, and the columns ``more``."""
    d = sums.withColumn("_avg", safe_div(from_cents("_s"), "_k"))
    return d.select(
        "data_venda", "loja_id",
        from_cents("_r").alias("receita"),
        round_to("_avg", 2).alias("media_movel_7d"),
        round_to(safe_div(F.lit(100.0) * (from_cents("_r") - F.col("_avg")), "_avg"), 2).alias("desvio_pct"), *more)


def _weekday_label(c):
    expr = None
    for i, name in enumerate(WEEKDAY_NAMES):
        expr = (F.when(c == i, F.lit(name)) if expr is None else expr.when(c == i, F.lit(name)))
    return expr


def sazonalidade_dia(vendas: DataFrame, daily: DataFrame | None = None) -> DataFrame:
    """per (store, weekday) revenue **sum** (named ``receita_media`` as in the reference) and its index against
    the mean of that store's weekday sums."""
    keys = ["loja_id", weekday0().alias("dia_semana")]
    d = (daily.groupBy(*keys).agg(F.sum("_r").alias("_r")) if daily is not None
         else vendas.groupBy(*keys).agg(F.sum(cents("valor_total", vendas)).alias("_r")))
    w = Window.partitionBy("loja_id")
    media = safe_div(from_cents(F.sum("_r").over(w)), F.count(F.lit(1)).over(w))
    return d.select(
        "loja_id",
        _weekday_label(F.col("dia_semana")).alias("dia_da_semana"),
        "dia_semana",
        round_to(from_cents("_r"), 2).alias("receita_media"),
        round_to(safe_div(from_cents("_r"), media), 2).alias("indice_sazonal"))


def top_produtos(vendas: DataFrame, k: int = TOP_K_PRODUCTS) -> DataFrame:
    """F8: top ``k`` products by revenue per (store, month); ties broken by the lower product id.

    ``row_number() … <= k`` is planned as a WindowGroupLimit: each map task keeps only its local top ``k`` per group
    before the shuffle, so a hot (store, month) sends at most ``k`` rows per task to the final ranking.
    """
    agg = vendas.groupBy("loja_id", month_key().alias("mes"), "produto_id").agg(F.sum(cents("valor_total", vendas)).alias("_r"))
    return top_products(agg, k)


def top_products(agg: DataFrame, k: int = TOP_K_PRODUCTS, month: str = "mes") -> DataFrame:
    """F8 from the revenue (_r) of every store, month (``month``: its key, or a date in it) and product."""
    w = Window.partitionBy("loja_id", month).orderBy(F.desc("_r"), F.asc("produto_id"))
    ranked = agg.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select("loja_id", F.col(month) if month == "mes" else month_key(month).alias("mes"), "produto_id",
                         from_cents("_r").alias("receita"), F.col("rank").cast("bigint").alias("rank"))


def build_features(vendas: DataFrame, ref_date: dt.date, share=None) -> dict[str, DataFrame]:
    """all eight tables from one cleaned sales frame.

    ``share(df, name) -> df`` materializes the two shared aggregates (e.g. :func:`tillpoint.session.materialize`):
    then the fact is scanned four times (day × store, customer × month, store × category, store × month × product)
    instead of eight. Without it every table is an independent lazy plan. Like the reference, only recency uses
    ``ref_date``; F1–F3 take an optional cut-off of their own.
    """
    daily = share(daily_store(vendas), "diario_loja") if share else None
    by_month = share(customer_month(vendas), "cliente_mes") if share else None
    return {
        "ticket_medio": ticket_medio(vendas, daily=daily),
        "frequencia_cliente": frequencia_cliente(vendas, by_month=by_month),
        "share_categoria": share_categoria(vendas),
        "crescimento_mom": crescimento_mom(vendas, daily=daily),
        "recencia_cliente": recencia_cliente(vendas, ref_date, by_month=by_month),
        "tendencia_7d": tendencia_7d(vendas, daily=daily),
        "sazonalidade_dia": sazonalidade_dia(vendas, daily=daily),
        "top_produtos": top_produtos(vendas),
    }


def presentation_order(name: str, df: DataFrame) -> DataFrame:
    """The reference's ORDER BY for table ``name`` (use only at the presentation edge)."""
    return df.orderBy(*[F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in ORDERING[name]])
