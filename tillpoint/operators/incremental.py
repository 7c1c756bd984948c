"""Feature tables kept up to date by batches of sales, without reading earlier sales again.

Three levels of Parquet tables under one folder, all laid out by month:

* ``parciais/nome=<name>/mes=…/lote=…``: sums of one batch, additive over batches: per (day, store, customer), (store, category)
  and (store, product). A batch is named by the key of its rows, so one that is applied again (a rerun after a lost
  driver) overwrites its own folders and changes nothing.
* ``meses/<name>/mes=…``: the batches of a month merged. Only the months that a batch touches are read and replaced, by
  dynamic partition overwrite.
* ``tabelas/<feature>/…``: the eight feature tables. F1, F2 and F8 are replaced for the touched months only. F4 and F6 look
  back over earlier rows of a store, so they are replaced from the first touched month on; F3, F5 and F7 are totals over
  all months. These five read the merged aggregates, never the sales.

The result equals a full rebuild from all sales.

Sales are few per day, store and customer, so every table here is about as long as the sales, and what counts is how often rows are
shuffled. Rows are dealt once in ranges of the month and the store or customer; as they lie they are grouped, ranked and written
without another shuffle. The three kinds of sums of a batch come from one such shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.functions.numeric import cents
from tillpoint.operators import features as feat
from tillpoint.operators.features import month_key
from tillpoint.sources.io import content_metrics, key_from_metrics, path_exists, stage_done

#: Additive sums of a batch: the keys beside the month, and the sums.
PARTIALS = {"visitas": ["data_venda", "loja_id", "cliente_id"], "categorias": ["loja_id", "categoria"],
            "produtos": ["loja_id", "produto_id"]}
SUMS = {"visitas": ["_r", "n"], "categorias": ["_r", "_c"], "produtos": ["_r"]}
#: Columns of the sales that are used.
SALES_COLUMNS = ["data_venda", "loja_id", "cliente_id", "categoria", "produto_id", "valor_total", "custo"]
#: Rows that a task groups, about.
TASK_ROWS = 1 << 18


def _dealt(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """``n`` rows dealt in ranges of ``keys``, a month or day first: groups of these and more keys lie together, and a task has
    rows of few months."""
    return rows.repartitionByRange(max(1, -(-n // TASK_ROWS)), *keys)


def _together(jobs: list[Callable[[], None]]) -> None:
    """Run writes of different tables at once: the last tasks of one leave cores that the next can use."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        for running in [pool.submit(job) for job in jobs]:
            running.result()


class FeatureStore:
    """The tables under ``path``. ``vendas`` batches are cleaned sales (see ``validate.clean_sales``)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- folders ------------------------------------------------------------------------------------------------
    def _folder(self, level: str, name: str) -> str:
        return f"{self.path}/{level}/{name}"

    def _batches(self, name: str, months: list[str]) -> DataFrame:
        """Sums of the batches of some months; the other months' folders are not listed among the scan's files."""
        rows = self.spark.read.parquet(self._folder("parciais", f"nome={name}")).where(F.col("mes").isin(months))
        return rows.select("mes", "lote", *PARTIALS[name], *SUMS[name])

    def partial(self, name: str, months: list[str]) -> DataFrame:
        """Sums of all batches of some months."""
        return self._batches(name, months).groupBy("mes", *PARTIALS[name]).agg(*[F.sum(c).alias(c) for c in SUMS[name]])

    def merged(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._folder("meses", name))

    def table(self, name: str) -> DataFrame:
        """One of the eight feature tables as it stands."""
        out = self.spark.read.parquet(self._folder("tabelas", name))
        if name in ("ticket_medio", "tendencia_7d"):  # the month is their folder only
            return out.drop("mes")
        return out

    def _replace(self, df: DataFrame, level: str, name: str, parts: list[str]) -> None:
        """Replace the partitions that ``df`` has rows of; all others stay. The rows are written as they lie: in
        ranges of the month, as read from a table by month, or rebalanced by month."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
         .partitionBy(*parts).parquet(self._folder(level, name).rstrip("/")))

    # ---- batches ------------------------------------------------------------------------------------------------
    def add(self, vendas: DataFrame) -> list[str]:
        """Write the sums of one batch and return the months it touches. Sales without a date are an error, as in the
        validation of the full job."""
        if path_exists(self.spark, self._folder("parciais", "visitas")):
            raise ValueError(f"{self.path}: lotes gravados por uma versão anterior")
        m = vendas.agg(*content_metrics(vendas)).first()
        batch = "l" + key_from_metrics(vendas, m)
        done = f"{self.path}/lotes/{batch}"
        if not stage_done(done, self.spark):
            self._replace(self._sums(vendas, batch, m["_n"]), "parciais", "", ["nome", "mes", "lote"])
            # the months of the batch, from its own small sums, are its receipt: written last
            own = self.spark.read.parquet(self._folder("parciais", "nome=categorias")).where(F.col("lote") == batch)
            own.select(F.col("mes").cast("string").alias("mes")).distinct().coalesce(1).write.mode("overwrite").parquet(done)
        months = [r.mes for r in self.spark.read.schema("mes string").parquet(done).collect()]  # one row a month
        if None in months:
            raise ValueError("vendas sem data_venda")
        return sorted(months)

    def _sums(self, vendas: DataFrame, batch: str, n: int) -> DataFrame:
        """The sums of a batch of every kind (``nome``), columns of the other kinds NULL, from one shuffle of its sales."""
        rows = vendas.select(F.trunc("data_venda", "month").alias("_m"), *SALES_COLUMNS[:5], cents("valor_total", vendas).alias("_r"), cents("custo", vendas).alias("_c"),
                             F.lit(1).cast("bigint").alias("n"))
        keys, sums = [c for c in SALES_COLUMNS[:5] if c != "loja_id"], ["_r", "_c", "n"]  # all kinds have the store
        kinds = [F.struct(F.lit(name).alias("nome"), *[
            (F.col(c) if c in PARTIALS[name] + SUMS[name] else F.lit(None).cast(rows.schema[c].dataType)).alias(c) for c in keys + sums])
            for name in PARTIALS]
        dealt = _dealt(rows, n, "_m", "loja_id").select("_m", "loja_id", F.inline(F.array(*kinds)))
        return dealt.groupBy("_m", "loja_id", "nome", *keys).agg(*[F.sum(c).alias(c) for c in sums]).select(
            "nome", month_key("_m").alias("mes"), F.lit(batch).alias("lote"), "loja_id", *keys, *sums)

    def merge(self, months: list[str]) -> None:
        """Merge the batches of ``months`` into the month tables."""
        visits, products, shares = (self._batches(name, months) for name in ("visitas", "produtos", "categorias"))
        n_visits, n_products = visits.count(), products.count()  # from the files' footers
        # a month is shuffled as a date, half a text's bytes
        visits = visits.select(F.trunc("data_venda", "month").alias("_m"), *PARTIALS["visitas"], *SUMS["visitas"])
        products = products.select(F.to_date(F.concat("mes", F.lit("-01"))).alias("_m"), *PARTIALS["produtos"], *SUMS["produtos"])
        daily = (_dealt(visits, n_visits, "data_venda", "loja_id")
                 .groupBy("data_venda", "loja_id", "cliente_id").agg(F.sum("_r").alias("_r"), F.sum("n").alias("n"))
                 .groupBy("data_venda", "loja_id").agg(
                     F.sum("_r").alias("_r"), F.sum("n").alias("n_vendas"), F.count("cliente_id").alias("clientes_unicos"))
                 .withColumn("mes", month_key()))
        customers = (_dealt(visits, n_visits, "_m", "cliente_id")
                     .groupBy("_m", "cliente_id", "loja_id").agg(
                         F.sum("n").alias("n"), F.sum("_r").alias("_r"), F.max("data_venda").alias("_last"))
                     .groupBy("_m", "cliente_id").agg(
                         F.sum("n").alias("compras"), F.sum("_r").alias("_g"), F.count("loja_id").alias("lojas_visitadas"),
                         F.max("_last").alias("_last"))
                     .withColumn("mes", month_key("_m")).drop("_m"))
        sold = (_dealt(products, n_products, "_m", "loja_id")
                .groupBy("_m", "loja_id", "produto_id").agg(F.sum("_r").alias("_r")))
        # the sums of a month's only batch are merged as they are
        found = shares.groupBy("mes").agg(F.count_distinct("lote").alias("n")).where("n > 1").collect()  # a row a month
        several = F.col("mes").isin([r.mes for r in found])
        again = shares.where(several).groupBy("mes", "loja_id", "categoria").agg(F.sum("_r").alias("_r"), F.sum("_c").alias("_c"))
        shares = shares.where(~several).drop("lote").unionByName(again.hint("rebalance", "mes"))
        _together([lambda: self._replace(daily, "meses", "diario_loja", ["mes"]),
                   lambda: self._replace(customers, "meses", "cliente_mes", ["mes"]),
                   lambda: self._replace(shares, "meses", "categorias", ["mes"]),
                   lambda: self._replace(feat.top_products(sold, month="_m"), "tabelas", "top_produtos", ["mes"])])

    def refresh(self, months: list[str], ref_date: dt.date) -> None:
        """Bring the feature tables up to date after ``merge(months)``."""
        touched, onwards = F.col("mes").isin(months), F.col("mes") >= F.lit(months[0])
        daily, customers = self.merged("diario_loja"), self.merged("cliente_mes")
        month = month_key()
        # by store, then by month: whole sums are shuffled, their quotients are made afterwards
        moving = feat.moving_sums(daily).withColumn("mes", month).where(onwards).hint("rebalance", "mes")
        by_month = {"ticket_medio": feat.ticket_medio(daily, daily=daily.where(touched)).withColumn("mes", month),
                    "frequencia_cliente": feat.frequencia_cliente(customers, by_month=customers.where(touched)),
                    "crescimento_mom": feat.crescimento_mom(daily, daily=daily).where(onwards).hint("rebalance", "mes"),
                    "tendencia_7d": feat.moving_trend(moving, "mes")}
        totals = {"share_categoria": feat.category_shares(self.merged("categorias").groupBy("loja_id", "categoria").agg(
                      F.sum("_r").alias("_r"), F.sum("_c").alias("_c"))),
                  "recencia_cliente": feat.recencia_cliente(customers, ref_date, by_month=customers),
                  "sazonalidade_dia": feat.sazonalidade_dia(daily, daily=daily)}
        _together([*[lambda name=name, df=df: self._replace(df, "tabelas", name, ["mes"]) for name, df in by_month.items()],
                   *[lambda name=name, df=df: df.write.mode("overwrite").option("compression", "zstd").parquet(self._folder("tabelas", name))
                     for name, df in totals.items()]])

    def apply(self, vendas: DataFrame, ref_date: dt.date) -> list[str]:
        """Add a batch of cleaned sales and bring all eight tables up to date; the touched months. A batch that was
        applied before changes no table; an empty one touches nothing."""
        if vendas.isEmpty():
            return []
        months = self.add(vendas)
        self.merge(months)
        self.refresh(months, ref_date)
        return months

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in feat.FEATURE_NAMES}
