"""Views that map the shared TPC-H-like test tables onto the three retail schemas.

``vendas``       sales fact: lineitem ⋈ orders ⋈ part ⋈ supplier ⋈ nation ⋈ region
``vendas_suja``  ``vendas`` with planted defects, to exercise validation and cleaning
``clientes_dq``  customer master with planted defects, for the data-quality audit

The store/panel view (store × month) is derived from ``vendas`` by :mod:`tillpoint.operators.panel`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.functions.numeric import money, safe_div
from tillpoint.sources.tables import table

# Fixed "today" used for recency (F5) and freshness (D2) on the test tables.
REF_DATE = dt.date(2001, 12, 1)


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store (supplier) → region name; join strategies follow the measured sizes (Catalyst, AQE)."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    reg = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
               .join(reg, nat.n_regionkey == reg.r_regionkey)
               .select("s_suppkey", "r_name"))


SALES_COLUMNS = ["data_venda", "loja_id", "produto_id", "categoria", "quantidade", "valor_unitario",
                 "valor_total", "custo", "cliente_id", "canal_venda", "regiao"]


def _sales(spark: SparkSession, sf_dir: str, keep_orderkey: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    stores = store_dim(spark, sf_dir)
    # lineitem ⋈ orders is fact-to-fact: left to a shuffle join keyed on the order key
    j = (li.join(od, li.l_orderkey == od.o_orderkey)
           .join(part, li.l_partkey == part.p_partkey)
           .join(stores, li.l_suppkey == stores.s_suppkey))
    cols = [
        F.to_date("l_shipdate").alias("data_venda"),
        F.col("l_suppkey").alias("loja_id"),
        F.col("l_partkey").alias("produto_id"),
        F.col("p_type").alias("categoria"),
        F.col("l_quantity").cast("bigint").alias("quantidade"),
        safe_div("l_extendedprice", "l_quantity").alias("valor_unitario"),
        money("l_extendedprice").alias("valor_total"),
        money(F.floor(F.col("l_extendedprice") * F.lit(60.0) + F.lit(0.5)) / F.lit(100.0)).alias("custo"),
        F.col("o_custkey").alias("cliente_id"),
        F.col("o_orderpriority").alias("canal_venda"),
        F.col("r_name").alias("regiao"),
    ]
    if keep_orderkey:
        cols.append(F.col("l_orderkey").alias("_orderkey"))
    return j.select(*cols)


def vendas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales fact with the reference's 11 columns (one row per line item)."""
    return _sales(spark, sf_dir)


def vendas_suja(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vendas`` with deterministic defects keyed on the order key (every row is kept):
    quantity -1 where key % 97 = 5, NULL category where key % 101 = 3, zero total where key % 103 = 7."""
    k = F.col("_orderkey")
    v = _sales(spark, sf_dir, keep_orderkey=True)
    return v.select(
        "data_venda", "loja_id", "produto_id",
        F.when(k % 101 == 3, F.lit(None).cast("string")).otherwise(F.col("categoria")).alias("categoria"),
        F.when(k % 97 == 5, F.lit(-1).cast("bigint")).otherwise(F.col("quantidade")).alias("quantidade"),
        "valor_unitario",
        F.when(k % 103 == 7, money(F.lit(0))).otherwise(F.col("valor_total")).alias("valor_total"),
        "custo", "cliente_id", "canal_venda", "regiao",
    )


def clientes_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer master for the audit: customer ⟕ (orders per customer), with planted defects by customer key."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    per_cust = (table(spark, sf_dir, "orders")
                .groupBy("o_custkey")
                .agg(F.count(F.lit(1)).alias("n_pedidos"),
                     F.to_date(F.min("o_orderdate")).alias("primeiro"),
                     F.to_date(F.max("o_orderdate")).alias("ultimo")))
    j = c.join(per_cust, c.c_custkey == per_cust.o_custkey, "left")
    k = F.col("c_custkey")
    key_s = k.cast("string")
    return j.select(
        k.alias("cliente_id"),
        F.col("c_name").alias("nome"),
        F.concat(F.lit("CPF-"), F.when(k % 250 == 249, k - 1).otherwise(k).cast("string")).alias("cpf"),
        F.concat(F.lit("user"), key_s, F.when(k % 300 == 7, F.lit("")).otherwise(F.lit("@")),
                 F.lit("example.com")).alias("email"),
        F.when(k % 50 == 0, F.lit("alt@example.com")).alias("email_alt"),
        F.when(k % 12 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("tel"), key_s)).alias("telefone"),
        F.col("c_mktsegment").alias("estado"),
        F.when(F.col("c_acctbal") < -900, F.lit(-1).cast("bigint"))
         .otherwise((k % 57 + 18).cast("bigint")).alias("idade"),
        F.when(k % 25 == 3, F.lit(None).cast("double"))
         .when(k % 700 == 11, F.lit(100000.0))
         .otherwise(F.col("c_acctbal")).alias("renda"),
        F.coalesce(F.col("n_pedidos"), F.lit(0)).cast("bigint").alias("compras_12m"),
        F.when(k % 400 == 9, F.date_add("primeiro", 100))
         .otherwise(F.date_sub("primeiro", 9000)).alias("data_nascimento"),
        F.col("primeiro").alias("data_cadastro"),
        F.col("ultimo").alias("data_atualizacao"),
    )


# The six product types of the test tables, used as the panel's share categories.
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
