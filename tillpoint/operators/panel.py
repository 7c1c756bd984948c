"""Store × month panel for the revenue forecast.

One grouped aggregate over the sales fact produces every monthly measure at once — revenue, cost, sale count,
the revenue of each category (conditional sums) and of each weekday, and distinct customers. Everything else is a window over the
*monthly* rows of one store (``partitionBy("loja_id")``), so the window input is bounded by the number of months per store, whatever the size of the fact. The only global
quantity (mean monthly revenue over all stores, for the size class) is a scalar subquery over the same aggregate.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.functions.numeric import cents, from_cents, round_to, safe_div
from tillpoint.operators.features import month_key, weekday0, with_distinct
from tillpoint.session import materialize

# Size classes and their bounds on (store mean monthly revenue / mean over all stores).
SIZE_SMALL, SIZE_MEDIUM, SIZE_LARGE = "Pequeno", "Médio", "Grande"
SIZE_LOW, SIZE_HIGH = 0.9, 1.1

# Name of all categories outside a given list.
OTHER_CATEGORY = "Outras"


def share_column(category: str) -> str:
    return "share_" + re.sub(r"[^0-9a-z]+", "_", category.lower()).strip("_")


def _argmax(values: list[Column], labels: list) -> Column:
    """Label of the largest value; ties go to the first label."""
    if not values:
        return F.lit(None).cast("string")
    if len(values) == 1:
        return F.lit(labels[0])
    top = F.greatest(*values)
    expr = None
    for v, lab in zip(values, labels):
        expr = F.when(v == top, F.lit(lab)) if expr is None else expr.when(v == top, F.lit(lab))
    return expr


def learn_categories(vendas: DataFrame) -> list[str]:
    """Categories in the data, by name. Each becomes a column of the panel, so the list is as long as its schema."""
    rows = vendas.select("categoria").where(F.col("categoria").isNotNull()).distinct().orderBy("categoria").collect()
    return [r["categoria"] for r in rows]


def monthly(vendas: DataFrame, categories: list[str]) -> DataFrame:
    """Store × month measures: exact sums per category, of all other categories, and per weekday; counts.

    Distinct customers come from (store, month, customer) keys of their own, which join the same aggregate (see
    ``features.with_distinct``): nothing is shuffled for a join. The month is a date until the end: half a text's bytes.
    """
    v = vendas.select("loja_id", "categoria", "cliente_id", F.trunc("data_venda", "month").alias("_mes"),
                      weekday0().alias("_dow"), cents("valor_total", vendas).alias("_v"),
                      cents("custo", vendas).alias("_cost"))
    listed = F.coalesce(F.col("categoria").isin(*categories), F.lit(False)) if categories else F.lit(False)
    sums = {"_r": (F.sum, F.col("_v")), "_c": (F.sum, F.col("_cost")), "n_vendas": (F.sum, F.lit(1).cast("bigint"))}
    for i, c in enumerate(categories):
        sums[f"_cat{i}"] = (F.sum, F.when(F.col("categoria") == F.lit(c), F.col("_v")))
    sums[f"_cat{len(categories)}"] = (F.sum, F.when(~listed, F.col("_v")))
    for k in range(7):
        sums[f"_wd{k}"] = (F.sum, F.when(F.col("_dow") == F.lit(k), F.col("_v")))
    out = with_distinct(v, ["loja_id", "_mes"], sums, "cliente_id", "n_clientes")
    return out.select("loja_id", month_key("_mes").alias("mes"), *sums, "n_clientes")


def store_regions(vendas: DataFrame) -> DataFrame:
    """(loja_id, regiao): the first region of each store by name, NULL if none is known.

    Its own aggregate: the least of a text has no fixed width, so beside the sums it would turn the aggregate of all sales into
    a sort. Here each store's distinct regions are written, and only those are sorted (unwritten, Spark would drop the
    ``distinct`` below the ``min`` and sort the sales).
    """
    pairs = materialize(vendas.select("loja_id", "regiao").distinct(), "regioes")
    return pairs.groupBy("loja_id").agg(F.min("regiao").alias("regiao"))


def build_panel(vendas: DataFrame, categories: list[str] | None = None, keep_last: bool = False) -> DataFrame:
    """The forecast panel: one row per (store, month) with the reference's feature set and ``target`` =
    next month's revenue. Rows without a target (each store's last month) are dropped unless ``keep_last``.

    The region is an attribute of the store: its first one by name (NULL if none is known). ``categories=None`` takes the
    categories from the data; with a given list, all other sales count as category ``Outras`` and the column
    ``share_outras`` is added. Sales without a category count in the revenue and, with a list, as ``Outras``.
    """
    given = categories is not None
    categories = list(categories) if given else learn_categories(vendas)
    m = monthly(vendas, categories)
    labels = categories + [OTHER_CATEGORY] if given else categories
    zero = F.lit(0).cast("bigint")
    cats = [F.coalesce(F.col(f"_cat{i}"), zero) for i in range(len(labels))]
    wds = [F.coalesce(F.col(f"_wd{k}"), zero) for k in range(7)]
    m = m.select("loja_id", "mes", "_r", "_c", "n_vendas", "n_clientes",
                 *[c.alias(f"_cat{i}") for i, c in enumerate(cats)],
                 *[w.alias(f"_wd{k}") for k, w in enumerate(wds)])
    # The monthly aggregate is read twice (windows + the global mean below): write it once to the shared
    # checkpoint folder so the sales scan and shuffle run once and the lineage to the raw tables is cut.
    m = materialize(m, "painel_mensal")

    # global mean monthly revenue: a scalar subquery over the checkpointed monthly rows
    overall = m.agg(safe_div(from_cents(F.sum("_r")), F.count(F.lit(1))).alias("g")).select("g").scalar()

    store = Window.partitionBy("loja_id")
    ordered = Window.partitionBy("loja_id").orderBy("mes")
    receita = from_cents("_r")
    ticket = round_to(safe_div(from_cents("_r"), "n_vendas"), 2)
    custo_pct = round_to(safe_div(from_cents("_c"), from_cents("_r")), 4)
    store_mean = safe_div(from_cents(F.sum("_r").over(store)), F.count(F.lit(1)).over(store))
    lifetime = [F.sum(f"_cat{i}").over(store) for i in range(len(labels))]

    p = m.select(
        "loja_id", "mes", "_r", "n_vendas", "n_clientes",
        F.year(F.to_date(F.concat(F.col("mes"), F.lit("-01")))).cast("bigint").alias("ano"),
        receita.alias("receita"),
        ticket.alias("ticket_medio"),
        custo_pct.alias("custo_pct"),
        *[round_to(safe_div(from_cents(f"_cat{i}"), from_cents("_r")), 4).alias(share_column(c))
          for i, c in enumerate(labels)],
        _argmax(wds, list(range(7))).cast("bigint").alias("dia_semana_pico"),
        F.max("n_vendas").over(store).cast("bigint").alias("area_m2"),
        F.max("n_clientes").over(store).cast("bigint").alias("funcionarios"),
        _argmax(lifetime, labels).alias("categoria_principal"),
        round_to(safe_div(from_cents("_r"), store_mean), 4).alias("sazonalidade_mes"),
        safe_div(store_mean, overall).alias("_size_ratio"),
        F.row_number().over(ordered).alias("_i"),
        F.lag("_r", 3).over(ordered).alias("_r3"),
        F.lag("_r", 6).over(ordered).alias("_r6"),
        F.lag(ticket, 1).over(ordered).alias("_t1"),
        F.lag(ticket, 2).over(ordered).alias("_t2"),
        F.lag("n_clientes", 1).over(ordered).alias("_n1"),
        F.lag("n_clientes", 2).over(ordered).alias("_n2"),
        F.lead(receita, 1).over(ordered).alias("target"),
    )
    # The windows leave the rows by store, so they are joined as they lie (many stores' regions are a small file: without the
    # hint they would be broadcast). NULL joins nothing: sales without a store get their region from a scalar.
    regions = store_regions(vendas).withColumnRenamed("loja_id", "_loja")
    no_store = regions.where(F.col("_loja").isNull()).agg(F.min("regiao").alias("r")).select("r").scalar()
    p = p.join(regions.hint("merge"), F.col("loja_id") == F.col("_loja"), "left").withColumn(
        "regiao", F.when(F.col("loja_id").isNull(), no_store).otherwise(F.col("regiao")))
    # Growth against 3 and 6 rows back (0 when that row does not exist). P2 deliberately has no look-ahead.
    growth3 = F.coalesce(round_to((safe_div(from_cents("_r"), from_cents("_r3")) - F.lit(1.0)) * F.lit(100.0), 2),
                         F.lit(0.0))
    growth6 = F.coalesce(round_to((safe_div(from_cents("_r"), from_cents("_r6")) - F.lit(1.0)) * F.lit(100.0), 2),
                         F.lit(0.0))
    # Mean of the last three rows from the third row on, else 0 (ticket mean on exact 2-dp decimals)
    t3 = safe_div(from_cents(cents("_t2") + cents("_t1") + cents("ticket_medio")), F.lit(3.0))
    ticket3 = F.when(F.col("_i") >= 3, round_to(t3, 2)).otherwise(F.lit(0.0))
    clientes3 = F.when(F.col("_i") >= 3, F.floor((F.col("_n2") + F.col("_n1") + F.col("n_clientes")) / F.lit(3))
                       ).otherwise(F.lit(0)).cast("bigint")
    # Margin from the rounded cost share, as the reference does
    margem = round_to(F.col("receita") * (F.lit(1.0) - F.col("custo_pct")), 2)
    share_cols = [share_column(c) for c in labels]
    ratio = F.col("_size_ratio")
    porte = (F.when(ratio < SIZE_LOW, F.lit(SIZE_SMALL)).when(ratio > SIZE_HIGH, F.lit(SIZE_LARGE))
             .otherwise(F.lit(SIZE_MEDIUM)))
    out = p.select(
        "loja_id", "regiao", porte.alias("porte"), "categoria_principal", "area_m2", "funcionarios", "mes", "ano",
        "receita", "ticket_medio", F.col("n_clientes").cast("bigint").alias("n_clientes"), "custo_pct",
        margem.alias("margem"), *share_cols,
        growth3.alias("crescimento_3m"), growth6.alias("crescimento_6m"),
        ticket3.alias("ticket_3m_avg"), clientes3.alias("clientes_3m_avg"),
        "sazonalidade_mes", "dia_semana_pico", "target")
    return out if keep_last else out.dropna(subset=["target"])


# ---- shares of any number of categories ---------------------------------------------------------------------------
def long_shares(vendas: DataFrame) -> DataFrame:
    """P6 in long form: (loja_id, mes, categoria, receita_categoria, share) of the categories that a store sold in a month.

    One row per store, month and category, no column and no value on the driver for any of them: products or parts can be
    the categories. The share is of all revenue; sales without a category count in the revenue only.
    """
    v = vendas.select("loja_id", "categoria", month_key().alias("mes"), cents("valor_total", vendas).alias("_v"))
    sums = v.groupBy("loja_id", "mes", "categoria").agg(F.sum("_v").alias("_r"))
    total = F.sum("_r").over(Window.partitionBy("loja_id", "mes"))
    share = round_to(safe_div(from_cents("_r"), from_cents(total)), 4)
    return (sums.select("loja_id", "mes", "categoria", from_cents("_r").alias("receita_categoria"), share.alias("share"))
            .where(F.col("categoria").isNotNull()))


def main_category(vendas: DataFrame) -> DataFrame:
    """P5 for any number of categories: (loja_id, categoria_principal), the one of most revenue; ties to the first by name."""
    sums = vendas.where(F.col("categoria").isNotNull()).groupBy("loja_id", "categoria").agg(F.sum(cents("valor_total", vendas)).alias("_r"))
    return sums.groupBy("loja_id").agg(F.min(F.struct((-F.col("_r")).alias("menos"), "categoria")).alias("b")).select(
        "loja_id", F.col("b.categoria").alias("categoria_principal"))


def sparse_shares(vendas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M1 for any number of categories: the table of levels (nivel, posicao), and per store and month the share vector in
    sparse form: (loja_id, mes, tamanho, posicoes, valores), positions ascending.

    The vector is assembled by aggregation; a row holds the categories that the store sold in the month, whatever their number
    in all. Levels get their positions in the cluster (``ml.level_table``).
    """
    from tillpoint.operators.ml import level_table
    shares = materialize(long_shares(vendas), "shares")
    levels = materialize(level_table(shares, "categoria"), "categorias")
    size = levels.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    # the levels have no bound, and their file is much smaller than their rows: not to be broadcast (see ml.dummies_by_table)
    named = shares.join(levels.hint("shuffle_hash"), F.col("categoria").cast("string") == F.col("nivel"))
    pairs = named.groupBy("loja_id", "mes").agg(F.sort_array(F.collect_list(F.struct("posicao", "share"))).alias("p"))
    return levels, pairs.select("loja_id", "mes", size.alias("tamanho"), F.col("p.posicao").alias("posicoes"),
                                F.col("p.share").alias("valores"))


def perfil_painel(panel: DataFrame) -> DataFrame:
    """R2: stores, rows, mean/min/max target and null cells outside the target (one aggregate)."""
    others = [c for c in panel.columns if c != "target"]
    nulls = sum((F.col(c).isNull().cast("bigint") for c in others), F.lit(0).cast("bigint"))
    return panel.agg(
        F.count_distinct("loja_id").cast("bigint").alias("n_lojas"),
        F.count(F.lit(1)).cast("bigint").alias("n_linhas"),
        round_to(F.avg("target"), 2).alias("target_medio"),
        F.min("target").alias("target_min"), F.max("target").alias("target_max"),
        F.sum(nulls).cast("bigint").alias("celulas_nulas"))
