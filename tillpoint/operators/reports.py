"""Profiles and the consumer queries shown with the reference's results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.functions.numeric import cents, from_cents, round_to, safe_div
from tillpoint.operators.features import crescimento_mom


def perfil_vendas(vendas: DataFrame) -> DataFrame:
    """Period, distinct stores/products/customers, sale count, total revenue and mean ticket.

    Each distinct count is an aggregate of its own over one column (a scalar subquery of the distinct values, which Spark
    does not merge with the others): together they would make it expand every row three times.
    """
    def distinct(column: str, name: str):
        return vendas.select(column).distinct().agg(F.count(column).alias("d")).select("d").scalar().alias(name)

    return vendas.agg(
        F.min("data_venda").alias("data_inicio"), F.max("data_venda").alias("data_fim"), F.count(F.lit(1)).alias("n_vendas"),
        F.sum(cents("valor_total", vendas)).alias("_r"),
    ).select("*", distinct("loja_id", "n_lojas"), distinct("produto_id", "n_produtos"),
             distinct("cliente_id", "n_clientes")).select("data_inicio", "data_fim",
             *[F.col(c).cast("bigint").alias(c) for c in ("n_lojas", "n_produtos", "n_clientes", "n_vendas")],
             round_to(from_cents("_r"), 2).alias("receita_total"),
             round_to(safe_div(from_cents("_r"), "n_vendas"), 2).alias("ticket_medio"))


def top_lojas_ticket(vendas: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` stores with the highest mean ticket (ties → lower store id). Top-k is the feature here;
    Spark plans it as TakeOrderedAndProject (per-partition top-k, then a merge of k rows per partition)."""
    t = vendas.groupBy("loja_id").agg(F.sum(cents("valor_total", vendas)).alias("_r"), F.count(F.lit(1)).alias("_n"))
    return (t.select("loja_id", round_to(safe_div(from_cents("_r"), "_n"), 2).alias("ticket_medio"))
             .orderBy(F.desc("ticket_medio"), F.asc("loja_id")).limit(k))


def ultimos_meses_loja(vendas: DataFrame, loja_id: int, n: int = 3) -> DataFrame:
    """Month-over-month growth of one store, last ``n`` months. The store filter is on the window's partition
    key, so Catalyst pushes it below the window and down to the scan."""
    return (crescimento_mom(vendas).filter(F.col("loja_id") == F.lit(loja_id))
            .orderBy(F.desc("mes")).limit(n))
