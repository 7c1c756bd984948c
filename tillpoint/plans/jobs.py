"""The three jobs — feature engine, data-quality audit, forecast — as plain functions over DataFrames.

Stages write their intermediate tables to ``<run_dir>/<stage>`` under the shared checkpoint folder
(``spark.checkpoint.dir``): that cuts the lineage of the multi-way joins (a lost executor recomputes from the written
table, not from the raw inputs) and lets a rerun with the same ``run_dir`` skip stages whose output was committed.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillpoint.operators import features as feat
from tillpoint.operators import ml
from tillpoint.operators.incremental import FeatureStore
from tillpoint.operators.panel import build_panel
from tillpoint.operators.quality import audit
from tillpoint.operators.validate import (MSG_MISSING_COLUMN, clean_sales, missing_columns, only_store,
                                         report_from_metrics, validation_metrics)
from tillpoint.session import checkpoint_dir
from tillpoint.sources.io import (content_key, content_metrics, delete_path, key_from_metrics, move_path, path_exists, stage_done,
                                  write_table)


@dataclass
class RunReport:
    """What a run did."""
    job: str
    status: str = "started"
    tables: dict = field(default_factory=dict)
    rows: int = 0
    errors: list = field(default_factory=list)
    details: dict = field(default_factory=dict)
    stage_seconds: dict = field(default_factory=dict)
    seconds: float = 0.0

    def to_df(self, spark: SparkSession) -> DataFrame:
        """One-row frame with the report (details as a JSON string)."""
        d = asdict(self)
        return spark.createDataFrame([(self.job, self.status, len(self.tables), int(self.rows),
                                       json.dumps(d["errors"]), json.dumps(d["details"], default=str),
                                       float(self.seconds))],
                                     "job string, status string, n_tabelas int, linhas long, erros string, "
                                     "detalhes string, segundos double")


class _Clock:
    def __init__(self, report: RunReport):
        self.report, self.t0 = report, time.time()

    @contextmanager
    def stage(self, name: str):
        t = time.time()
        try:
            yield
        finally:
            self.report.stage_seconds[name] = round(time.time() - t, 3)

    def done(self, status: str):
        self.report.status = status
        self.report.seconds = round(time.time() - self.t0, 3)
        return self.report


def new_run_dir(spark: SparkSession, job: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{job}-{uuid.uuid4().hex[:12]}"


def _materialize(df: DataFrame, path: str) -> DataFrame:
    """Write a stage output once (skip if already committed) and continue from the written table."""
    if not stage_done(path, df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _write_all(tables: dict[str, DataFrame], output_dir: str, mode: str, parallel: int = 8,
               partition_by_month: bool = False) -> dict[str, int]:
    """Write independent tables as concurrent Spark jobs (each small job leaves cores idle on its own).
    With ``partition_by_month`` tables that have a ``mes`` column are laid out by month (partition pruning later)."""
    def one(item):
        name, df = item
        parts = ["mes"] if partition_by_month and "mes" in df.columns else None
        return name, write_table(df, f"{output_dir.rstrip('/')}/{name}", mode=mode, partition_by=parts)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return dict(pool.map(one, tables.items()))


# ---------------------------------------------------------------------------------------------------------------
def run_features(spark: SparkSession, vendas: DataFrame, output_dir: str, ref_date: dt.date,
                 run_dir: str | None = None, mode: str = "overwrite", parallel: int = 8,
                 partition_by_month: bool = False) -> RunReport:
    """Feature engine: validate → clean → 8 feature tables → save. An invalid input leaves nothing behind, and the problems
    are returned.

    One pass over the input writes the cleaned rows to a staging folder and observes the validation counts and a key of all
    rows; the folder becomes the stage output if the input is valid, else it is deleted. Stage outputs carry the key: a rerun
    with the same ``run_dir`` first reads the input for the key alone, and goes on from the outputs if it is the same."""
    rep = RunReport("features")
    clock = _Clock(rep)
    resumed = run_dir is not None and path_exists(spark, run_dir)
    run_dir = run_dir or new_run_dir(spark, "features")
    absent = missing_columns(vendas)
    if absent:
        rep.errors = [MSG_MISSING_COLUMN % c for c in absent]
        return clock.done("validate_fail")
    measures = [*validation_metrics(vendas), *content_metrics(vendas)]
    m = None
    if resumed:
        with clock.stage("validate"):
            m = vendas.agg(*measures).first().asDict()
    with clock.stage("transform"):
        known = m is not None and (not report_from_metrics(vendas, m)["valido"]
                                   or stage_done(f"{run_dir}/{key_from_metrics(vendas, m)}/vendas_limpo", spark))
        if not known:
            staging, seen = f"{run_dir}/entrada-{uuid.uuid4().hex[:12]}", Observation()
            clean_sales(vendas.observe(seen, *measures)).write.option("compression", "zstd").parquet(staging)
            m = seen.get
        r = report_from_metrics(vendas, m)
        stage = f"{run_dir}/{key_from_metrics(vendas, m)}"
        if not known and r["valido"]:
            move_path(spark, staging, f"{stage}/vendas_limpo")
        elif not known:
            delete_path(spark, staging if resumed else run_dir)
    rep.details.update(linhas=r["linhas"], colunas=r["colunas"], nulos=dict(r["nulos_por_coluna"] or {}),
                       removidas=r["removidas"], run_dir=run_dir)
    if not r["valido"]:
        rep.errors = list(r["problemas"])
        return clock.done("validate_fail")
    clean = spark.read.parquet(f"{stage}/vendas_limpo")
    rep.details["vendas_limpo"] = f"{stage}/vendas_limpo"
    with clock.stage("feature_calc+save"):
        # day × store (F1, F4, F6, F7) and customer × month (F2, F5) are written once, so the cleaned table is scanned
        # four times instead of eight
        builders = {"diario_loja": feat.daily_store, "cliente_mes": feat.customer_month}
        with ThreadPoolExecutor(max_workers=2) as pool:
            shared = dict(pool.map(lambda n: (n, _materialize(builders[n](clean), f"{stage}/{n}")), builders))
        tables = feat.build_features(clean, ref_date, share=lambda df, name: shared[name])
        rep.tables = _write_all(tables, output_dir, mode, parallel, partition_by_month)
    rep.rows = sum(rep.tables.values())
    return clock.done("done")


def run_features_batch(spark: SparkSession, vendas: DataFrame, store_dir: str, ref_date: dt.date) -> RunReport:
    """The feature engine for one batch of sales: validate → clean → add to the feature store at ``store_dir``. Earlier sales are
    not read; an invalid batch changes nothing, a batch added before neither (see ``operators.incremental``)."""
    rep = RunReport("features_batch")
    clock = _Clock(rep)
    absent = missing_columns(vendas)
    if absent:
        rep.errors = [MSG_MISSING_COLUMN % c for c in absent]
        return clock.done("validate_fail")
    with clock.stage("validate"):
        r = report_from_metrics(vendas, vendas.agg(*validation_metrics(vendas)).first().asDict())
    rep.details.update(linhas=r["linhas"], removidas=r["removidas"])
    if not r["valido"]:
        rep.errors = list(r["problemas"])
        return clock.done("validate_fail")
    store = FeatureStore(spark, store_dir)
    with clock.stage("add+merge+refresh"):
        rep.details["meses"] = store.apply(clean_sales(vendas), ref_date)
    if rep.details["meses"]:
        rep.tables = {name: t.count() for name, t in store.tables().items()}
    rep.rows = sum(rep.tables.values())
    return clock.done("done")


def run_quality(spark: SparkSession, clientes: DataFrame, ref_date: dt.date, **audit_kw) -> RunReport:
    """Data-quality audit: five dimensions from one aggregate, merged into the diagnosis (one result row)."""
    rep = RunReport("quality")
    clock = _Clock(rep)
    with clock.stage("audit"):
        a = audit(clientes, ref_date, **audit_kw).freeze()  # the two passes; the rest is one bounded row
        r = a.report().first()
        rep.details.update(
            colunas_criticas=[x.asDict() for x in a.completude_table().where("critica").collect()],
            frescor=a.frescor().first().asDict(),
            duplicatas={x["coluna"]: x["duplicatas"] for x in a.unicidade_table().collect()},
            violacoes={x["regra"]: x["violacoes"] for x in a.consistencia_table().collect()},
            outliers={x["coluna"]: x["outliers"] for x in a.acuracia_table().collect()})
    rep.details.update(linhas=r["linhas"], dimensoes=[d.asDict() for d in r["dimensoes"]],
                       score_qualidade=r["score_qualidade"], severidade=r["severidade"],
                       alertas=[x.asDict() for x in r["alertas"]])
    rep.rows = 1
    return clock.done("done")


def run_forecast(spark: SparkSession, panel: DataFrame, output_dir: str, loja_id=None,
                 models: list[str] | None = None, run_dir: str | None = None, model_params: dict | None = None,
                 train_partitions: int | None = None) -> RunReport:
    """Forecast: load → split → train → evaluate → select → deploy (best full pipeline saved to ``output_dir``)."""
    rep = RunReport("forecast")
    clock = _Clock(rep)
    fresh = run_dir is None
    run_dir = run_dir or new_run_dir(spark, "forecast")
    models = models or list(ml.MODELS)
    with clock.stage("load"):
        # a folder of the caller may hold outputs of another panel or store: the key tells them apart
        stage = run_dir if fresh else f"{run_dir}/{content_key(panel, loja_id)}"
        panel = _materialize(panel, f"{stage}/painel")
        summary = panel.agg(F.count_distinct("loja_id").alias("n_lojas"),
                            F.count_distinct("mes").alias("n_meses")).first()
    with clock.stage("split"):
        _, names, feats = ml.prepare_features(panel, loja_id=loja_id)
        split = _materialize(ml.exact_split(only_store(panel, loja_id)), f"{stage}/split")
        data = feats.transform(split).select(*ml.SPLIT_KEYS, "is_test", "features",
                                             F.col(ml.TARGET).cast("double").alias("label"))
        data = ml.training_layout(data, partitions=train_partitions).persist()
        train_df, test_df = data.filter(~F.col("is_test")), data.filter(F.col("is_test"))
        sizes = data.groupBy("is_test").count().collect()
    counts = {bool(r["is_test"]): r["count"] for r in sizes}
    rep.details.update(n_lojas=summary["n_lojas"], n_meses=summary["n_meses"], n_features=len(names), feature_names=names,
                       n_treino=counts.get(False, 0), n_teste=counts.get(True, 0))
    results, fitted = [], {}
    with clock.stage("train+evaluate"):
        for order, name in enumerate(models, start=1):
            model = ml.train(name, train_df, **(ml.storage_params(name, sum(counts.values())) | (model_params or {}).get(name, {})))
            fitted[name] = model
            m = ml.regression_metrics(model.transform(test_df)).first().asDict()
            results.append(dict(ordem=order, modelo=name, **m))
            if name == "LinearRegression":
                rep.details["ridge"] = model.getRegParam()
    with clock.stage("select+deploy"):
        best = max(results, key=lambda r: (r["r2"] if r["r2"] is not None else float("-inf"), -r["ordem"]))
        final = ml.full_model(feats, fitted[best["modelo"]])
        ml.save_model(final, f"{output_dir.rstrip('/')}/modelo")
    data.unpersist()
    rep.details.update(metricas=results, melhor=best["modelo"], melhor_r2=best["r2"], run_dir=run_dir)
    rep.tables = {"modelo": 1}
    rep.rows = len(results)
    return clock.done("done")


def panel_from_sales(vendas: DataFrame, categories: list[str] | None = None, cleaned: bool = False) -> DataFrame:
    """Derive the forecast panel from sales (pass ``cleaned=True`` for the feature job's cleaned stage output); the
    categories come from the data unless a list is given."""
    return build_panel(vendas if cleaned else clean_sales(vendas), categories)
