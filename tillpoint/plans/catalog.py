"""Registered queries: name → (spark, sf_dir) → DataFrame, each over the whole test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillpoint.operators import boosting
from tillpoint.operators import duplicates as dup
from tillpoint.operators import features as feat
from tillpoint.operators import heavy, incremental
from tillpoint.operators import least_squares as lsq
from tillpoint.operators import ml
from tillpoint.operators import outliers as outl
from tillpoint.operators import panel as pan
from tillpoint.operators import reports as rep
from tillpoint.operators import sketches as sk
from tillpoint.operators import validate as val
from tillpoint.operators.incremental import FeatureStore
from tillpoint.operators.quality import audit
from tillpoint.operators.validate import clean_sales
from tillpoint.plans import jobs
from tillpoint.session import checkpoint_dir, materialize
from tillpoint.sources import buckets, io
from tillpoint.sources import testdata as td

CUTOFF_DATE = dt.date(1999, 6, 30)


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_sales(td.vendas(spark, sf_dir))


def _feature(fn, *args):
    return lambda spark, sf_dir: fn(_sales(spark, sf_dir), *args)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ticket_medio": _feature(feat.ticket_medio),
    "ticket_medio_ate_data": _feature(feat.ticket_medio, CUTOFF_DATE),
    "frequencia_cliente": _feature(feat.frequencia_cliente),
    "frequencia_cliente_ate_data": _feature(feat.frequencia_cliente, CUTOFF_DATE),
    "share_categoria_ate_data": _feature(feat.share_categoria, CUTOFF_DATE),
    "share_categoria": _feature(feat.share_categoria),
    "crescimento_mom": _feature(feat.crescimento_mom),
    "recencia_cliente": _feature(feat.recencia_cliente, td.REF_DATE),
    "tendencia_7d": _feature(feat.tendencia_7d),
    "sazonalidade_dia": _feature(feat.sazonalidade_dia),
    "top_produtos": _feature(feat.top_produtos),
}


#: Column of each feature table that the summary adds up.
TABLE_SUMS = {"ticket_medio": "receita_total", "frequencia_cliente": "gasto_total", "share_categoria": "share_pct",
              "crescimento_mom": "crescimento_mom_pct", "recencia_cliente": "dias_desde_ultima", "tendencia_7d": "desvio_pct",
              "sazonalidade_dia": "indice_sazonal", "top_produtos": "receita"}
#: Within a month, so that both batches touch it.
BATCH_DATE = dt.date(1998, 6, 15)


def _new_dir(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _table_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table and the sum of one column in hundredths."""
    frames = [tables[name].agg(F.lit(name).alias("tabela"), F.count(F.lit(1)).alias("linhas"),
                               F.sum(F.round(F.col(c) * 100.0, 0).cast("bigint")).alias("soma")) for name, c in TABLE_SUMS.items()]
    return reduce(DataFrame.unionByName, frames)


def _feature_job(spark, sf_dir):
    """The whole job, its eight tables read back."""
    out = _new_dir(spark, "tabelas")
    # not written before: the job reads its input once and stages the cleaned rows
    report = jobs.run_features(spark, td.vendas(spark, sf_dir), out, td.REF_DATE)
    if report.status != "done":
        raise ValueError(report.errors)
    return _table_summary({name: io.read_table(spark, f"{out}/{name}") for name in report.tables})


def _in_batches(spark, sf_dir) -> FeatureStore:
    """The sales up to a day in the middle of a month, then all others."""
    store = FeatureStore(spark, _new_dir(spark, "incremental"))
    sales = materialize(_sales(spark, sf_dir).select(*incremental.SALES_COLUMNS), "vendas")
    early = F.col("data_venda") <= F.lit(BATCH_DATE)
    for part in (sales.where(early), sales.where(~early)):
        store.apply(part, td.REF_DATE)
    return store


def _copartitioned(spark, sf_dir):
    """Order lines and orders stored in the same buckets of the order key; revenue per channel and month from their
    join."""
    lines, orders = td.table(spark, sf_dir, "lineitem"), td.table(spark, sf_dir, "orders")
    n, names = buckets.buckets_for(lines.count(), 150), {}
    for df, key in ((lines, "l_orderkey"), (orders, "o_orderkey")):
        path = _new_dir(spark, f"buckets-{key}")
        names[key] = path.rsplit("/", 1)[1].replace("-", "_")
        buckets.write_bucketed(df, names[key], path, [key], n)
    li, od = names.values()
    joined = buckets.join_bucketed(spark, li, od, {li: ["l_extendedprice", "l_shipdate"], od: ["o_orderpriority"]})
    # the buckets serve the grouping by order as well: only sums per channel and month are shuffled
    per_order = joined.groupBy("l_orderkey", F.col("o_orderpriority").alias("canal_venda"), feat.month_key("l_shipdate").alias("mes")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("l_extendedprice") * 100.0, 0).cast("bigint")).alias("_r"))
    return per_order.groupBy("canal_venda", "mes").agg(F.sum("n").alias("n_vendas"), F.count(F.lit(1)).alias("n_pedidos"),
                                                       F.sum("_r").alias("receita_centavos"))


QUERIES.update({
    "vendas_copart_canal": _copartitioned,
    "features_oito_tabelas": _feature_job,
    "inc_resumo_tabelas": lambda spark, sf_dir: _table_summary(_in_batches(spark, sf_dir).tables()),
    "inc_tendencia_7d": lambda spark, sf_dir: _in_batches(spark, sf_dir).table("tendencia_7d"),
    "inc_frequencia_cliente": lambda spark, sf_dir: _in_batches(spark, sf_dir).table("frequencia_cliente"),
})


def _heavy_products(by_store):
    """F8 by summaries, per store and month or per month of the chain."""
    def run(spark, sf_dir):
        sales = _sales(spark, sf_dir).select("data_venda", "loja_id", "produto_id", "valor_total")
        return heavy.top_produtos(materialize(sales, "vendas_produtos"), by_store=by_store)
    return run


QUERIES.update({"top_produtos_resumo": _heavy_products(True), "top_produtos_rede": _heavy_products(False)})


def _sales_view(spark, sf_dir):
    """A4: the cleaned sales as a view, asked in SQL: revenue and customers per region and year."""
    name = f"vendas_{uuid.uuid4().hex[:12]}"
    io.register_sales(_sales(spark, sf_dir), name)
    return spark.sql(f"""
        SELECT regiao, CAST(year(data_venda) AS BIGINT) AS ano, COUNT(*) AS n_vendas,
               COUNT(DISTINCT cliente_id) AS clientes, CAST(SUM(valor_total) AS DOUBLE) AS receita
        FROM {name} GROUP BY regiao, year(data_venda)""")


def _one_store(spark, sf_dir):
    """The width of the features of one store alone: a category that it does not have gives no column."""
    panel = materialize(_panel(spark, sf_dir), "painel")
    frames = []
    for loja in (1, 2):
        rows, names, _ = ml.prepare_features(panel, loja_id=loja)
        frames.append(rows.agg(F.lit(loja).cast("bigint").alias("loja_id"), F.count(F.lit(1)).alias("n_linhas"),
                               F.lit(len(names)).cast("bigint").alias("n_features")))
    return reduce(DataFrame.unionByName, frames)


def _keep_first(spark, sf_dir):
    """A5: the first write of a table stays when a later one asks to keep it, and goes when it asks to overwrite it."""
    shares, out = feat.share_categoria(_sales(spark, sf_dir)), _new_dir(spark, "guardar")
    first = shares.where(F.col("categoria") != "PROMO")
    frames = []
    for step, (mode, rows) in enumerate((("overwrite", first), ("ignore", shares), ("overwrite", shares)), start=1):
        io.write_table(rows, f"{out}/share", mode=mode)
        kept = io.read_table(spark, f"{out}/share").agg(
            F.lit(step).cast("bigint").alias("passo"), F.lit(mode).alias("modo"), F.count(F.lit(1)).alias("linhas"),
            F.sum(F.round(F.col("share_pct") * 100.0, 0).cast("bigint")).alias("soma"))
        frames.append(materialize(kept, "guardado"))
    return reduce(DataFrame.unionByName, frames)


QUERIES.update({"vendas_por_sql": _sales_view, "ml_largura_loja": _one_store, "features_guardar_primeira": _keep_first})


def _flat_report(spark, sf_dir):
    r = val.schema_report(td.vendas_suja(spark, sf_dir))
    return r.select("valido", F.array_join("problemas", " | ").alias("problemas"), "linhas", "colunas", "removidas")


def _audit(spark, sf_dir):
    return audit(td.clientes_dq(spark, sf_dir), td.REF_DATE)


def _diagnostico(spark, sf_dir):
    return _audit(spark, sf_dir).diagnostico().withColumn("n_alertas", F.size("alertas").cast("bigint")).drop(
        "alertas")


QUERIES.update({
    "validacao_nulos": lambda spark, sf_dir: val.null_counts(td.vendas_suja(spark, sf_dir)),
    "validacao_relatorio": _flat_report,
    "limpeza_vendas": lambda spark, sf_dir: clean_sales(td.vendas_suja(spark, sf_dir)),
    "perfil_vendas": lambda spark, sf_dir: rep.perfil_vendas(_sales(spark, sf_dir)),
    "top_lojas_ticket": lambda spark, sf_dir: rep.top_lojas_ticket(_sales(spark, sf_dir)),
    "ultimos_meses_loja": lambda spark, sf_dir: rep.ultimos_meses_loja(_sales(spark, sf_dir), 1),
    "dq_completude": lambda spark, sf_dir: _audit(spark, sf_dir).completude_table(),
    "dq_frescor": lambda spark, sf_dir: _audit(spark, sf_dir).frescor(),
    "dq_unicidade": lambda spark, sf_dir: _audit(spark, sf_dir).unicidade_table(),
    "dq_consistencia": lambda spark, sf_dir: _audit(spark, sf_dir).consistencia_table(),
    "dq_acuracia": lambda spark, sf_dir: _audit(spark, sf_dir).acuracia_table(),
    "dq_dimensoes": lambda spark, sf_dir: _audit(spark, sf_dir).dimensoes(),
    "dq_diagnostico": _diagnostico,
    "dq_alertas": lambda spark, sf_dir: _audit(spark, sf_dir).alertas(),
    "dq_celulas_nulas": lambda spark, sf_dir: _audit(spark, sf_dir).overall_null_pct(),
    "perfil_clientes": lambda spark, sf_dir: _audit(spark, sf_dir).profile(),
})


def _filtered_duplicates(spark, sf_dir):
    """D3 by the two-pass filter, of a key and of two columns with many repeats."""
    clientes = materialize(td.clientes_dq(spark, sf_dir).select("cpf", "telefone", "email_alt"), "clientes")
    return reduce(DataFrame.unionByName, [dup.count_duplicates(clientes, k) for k in clientes.columns])


def _duplicate_lines(spark, sf_dir):
    """D3, the values: products that a store sold more than once on a day."""
    lines = td.table(spark, sf_dir, "lineitem")
    pair = F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                       F.to_date("l_shipdate").cast("string"))
    return dup.duplicate_keys(lines.select(pair.alias("chave")), "chave")


def _customer_levels(spark, sf_dir):
    """Distinct customers of every level, exact, and whether the rolled-up sketches are within their bound."""
    sales = materialize(_sales(spark, sf_dir).select("data_venda", "loja_id", "cliente_id"), "vendas_clientes")
    daily = materialize(sk.daily_sketches(sales), "esbocos")
    return sk.compare_levels(sk.exact_levels(sales, materialize), sk.estimated_levels(daily), sk.error_bound())


def _one_scan_outliers(spark, sf_dir):
    """D5 in one full scan and a look at the boundary cells."""
    return outl.outliers(materialize(td.clientes_dq(spark, sf_dir).select("renda", "compras_12m"), "clientes"), ["renda", "compras_12m"])


def _shares_of_parts(spark, sf_dir):
    """P6 with as many categories as parts: long shares, with the place of each part among all."""
    sales = _sales(spark, sf_dir).select("data_venda", "loja_id", "valor_total", F.col("produto_id").cast("string").alias("categoria"))
    _, rows = pan.sparse_shares(sales)
    return rows.select("loja_id", "mes", F.col("tamanho").alias("n_categorias"),
                       F.inline(F.arrays_zip(F.col("posicoes").alias("posicao"), F.col("valores").alias("share"))))


QUERIES.update({"dq_outliers_uma_leitura": _one_scan_outliers, "painel_share_pecas": _shares_of_parts})
QUERIES["clientes_niveis"] = _customer_levels
QUERIES.update({"dq_duplicatas_filtro": _filtered_duplicates, "dq_chaves_repetidas": _duplicate_lines})


def _panel_sales(spark, sf_dir):
    # the panel reads its sales four times (categories, sums, customers, regions): write the columns it needs once
    return materialize(_sales(spark, sf_dir).select("data_venda", "loja_id", "categoria", "valor_total", "custo",
                                                    "cliente_id", "regiao"), "vendas_painel")


def _panel(spark, sf_dir, keep_last=False):
    return pan.build_panel(_panel_sales(spark, sf_dir), keep_last=keep_last)


def _panel_listed(spark, sf_dir):
    p = pan.build_panel(_panel_sales(spark, sf_dir), ["LARGE", "PROMO", "SMALL"], keep_last=True)
    return p.select("loja_id", "mes", "categoria_principal", "share_large", "share_promo", "share_small", "share_outras")


def _panel_regions(spark, sf_dir):
    """Stores without a region and stores that have two of them."""
    loja, par = F.col("loja_id"), F.month("data_venda") % 2 == 0
    v = _panel_sales(spark, sf_dir).withColumn(
        "regiao", F.when(loja % 7 == 3, F.lit(None).cast("string"))
        .when((loja % 5 == 2) & par, F.concat(F.lit("A "), F.col("regiao"))).otherwise(F.col("regiao")))
    return pan.build_panel(v, keep_last=True).select("loja_id", "mes", "regiao", "receita", "target")


def _share_fractions(spark, sf_dir):
    """F3 on amounts with seven decimals."""
    return feat.share_categoria(_sales(spark, sf_dir).withColumn(
        "valor_total", (F.col("valor_total") * F.lit(Decimal("0.00375"))).cast("decimal(24,7)")))


QUERIES["share_categoria_fracoes"] = _share_fractions

QUERIES.update({
    "painel_target": lambda spark, sf_dir: _panel(spark, sf_dir),
    "painel_mensal": lambda spark, sf_dir: _panel(spark, sf_dir, keep_last=True).select(
        "loja_id", "mes", "ano", "receita", "ticket_medio", "n_clientes", "custo_pct", "margem", "target"),
    "painel_share": lambda spark, sf_dir: _panel(spark, sf_dir, keep_last=True).select(
        "loja_id", "mes", "categoria_principal", *[pan.share_column(c) for c in td.CATEGORIES]),
    "painel_fora_da_lista": _panel_listed,
    "painel_regioes": _panel_regions,
    "perfil_painel": lambda spark, sf_dir: pan.perfil_painel(_panel(spark, sf_dir)),
})


def _split_panel(spark, sf_dir):
    # the split reads its input twice (histogram, ranking): split a written panel, as the forecast job does
    return ml.exact_split(materialize(_panel(spark, sf_dir), "painel"))


def _dummies_long(spark, sf_dir):
    panel = materialize(_panel(spark, sf_dir), "painel")
    return ml.dummies_long(panel, ml.fit_dummies(panel, ml.CATEGORICAL), ["loja_id", "mes"])


def _dummies_many_levels(spark, sf_dir):
    """As many levels as orders, the entries that are set."""
    orders = td.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("pedido"))
    return ml.dummies_by_table(orders, "pedido", ml.level_table(orders, "pedido"), ["o_orderkey"])


def _baseline_metrics(spark, sf_dir):
    test = _split_panel(spark, sf_dir).filter("is_test")
    preds = F.array(
        F.struct(F.lit(1).cast("bigint").alias("ordem"), F.lit("persistencia").alias("modelo"),
                 F.col("receita").alias("prediction")),
        F.struct(F.lit(2).cast("bigint").alias("ordem"), F.lit("media_loja").alias("modelo"),
                 (F.col("receita") / F.nullif(F.col("sazonalidade_mes"), F.lit(0.0))).alias("prediction")))
    both = test.select(F.col("target").alias("label"), F.inline(preds))
    return ml.regression_metrics(both, by=("ordem", "modelo"))


def _resumo(spark, sf_dir):
    panel = materialize(_panel(spark, sf_dir), "painel")
    sp = ml.exact_split(panel)
    _, names, _ = ml.prepare_features(panel)
    return sp.agg(F.count_distinct("loja_id").cast("bigint").alias("n_lojas"),
                  F.count_distinct("mes").cast("bigint").alias("n_meses"),
                  F.lit(len(names)).cast("bigint").alias("n_features"),
                  F.count_if(~F.col("is_test")).cast("bigint").alias("n_treino"),
                  F.count_if("is_test").cast("bigint").alias("n_teste"))


def _assembled(spark, sf_dir):
    """Split panel with its features, written once (read by training and scoring). The levels are taken from the written panel,
    which has the rows of the split: the split is computed once."""
    panel = materialize(_panel(spark, sf_dir), "painel")
    _, names, feats = ml.prepare_features(panel)
    prepared = feats.transform(ml.exact_split(panel)).withColumn("label", F.col(ml.TARGET).cast("double"))
    return materialize(prepared.select("loja_id", "mes", "is_test", "features", "label"), "ml_painel"), names


def _model_predictions(name):
    def run(spark, sf_dir):
        data, _ = _assembled(spark, sf_dir)
        model = ml.train_split(name, data)
        return model.transform(data.filter("is_test")).select("loja_id", "mes", "label", "prediction")
    return run


def _model_metrics(spark, sf_dir):
    data, _ = _assembled(spark, sf_dir)
    frames = []
    for i, name in enumerate(ml.MODELS, start=1):
        m = ml.regression_metrics(ml.train_split(name, data).transform(data.filter("is_test")))
        frames.append(m.select(F.lit(i).cast("bigint").alias("ordem"), F.lit(name).alias("modelo"), "*"))
    return frames[0].unionByName(frames[1])


#: Features that a least squares model of its own is trained on.
SINGLE_FEATURES = ["receita", "n_clientes", "ticket_medio"]


def _trained_selection(spark, sf_dir):
    """M3b, M4, M5 over trained models: a line on each of three features, trained on the training rows, measured on the test
    rows; ``escolhido`` marks the one selected."""
    split = materialize(_split_panel(spark, sf_dir).select("loja_id", "mes", "is_test", F.col(ml.TARGET).alias("label"),
                                                           *SINGLE_FEATURES), "ml_divisao")
    scored = []
    for i, name in enumerate(SINGLE_FEATURES, start=1):
        rows = VectorAssembler(inputCols=[name], outputCol="features").transform(split)
        fitted = lsq.fit(rows.where("NOT is_test"), [name])
        scored.append(fitted.predict(rows.where("is_test")).select(
            F.lit(i).cast("bigint").alias("ordem"), F.lit(name).alias("modelo"), "label", "prediction"))
    metrics = materialize(ml.regression_metrics(reduce(DataFrame.unionByName, scored), by=("ordem", "modelo")), "ml_medidas")
    best = ml.select_best(metrics).select(F.col("ordem").alias("_o"))
    return metrics.join(F.broadcast(best), F.col("ordem") == F.col("_o"), "left").select(
        *metrics.columns, F.col("_o").isNotNull().alias("escolhido"))


def _boosting_data(spark, sf_dir, label):
    """Training rows with the validation flag, assembled for ``label`` and laid out for training."""
    train = _split_panel(spark, sf_dir).where("NOT is_test").drop("is_test")
    prepared, _, _ = ml.prepare_features(materialize(boosting.hold_out(materialize(train, "ml_treino")), "ml_reserva"), target=label)
    written = materialize(prepared.select("loja_id", "mes", boosting.VALIDATION, "features", "label"), "ml_rodadas")
    return ml.training_layout(written)


def _boosting_rounds(spark, sf_dir):
    """M8: errors of every round kept, for next month's revenue."""
    data = _boosting_data(spark, sf_dir, ml.TARGET)
    return boosting.round_errors(boosting.fit_rounds(data, rounds=30, depth=4), data)


def _boosting_summary(spark, sf_dir):
    """M8, trained on the revenue of the month itself, which its other features tell, so that many rounds are kept: sizes of the
    parts, whether each round lowers the validation error, whether the last one's is that of the model's predictions, and whether it
    is less than half that of the training mean."""
    data = _boosting_data(spark, sf_dir, "receita")
    model = boosting.fit_rounds(data, rounds=8, depth=4, step=0.3)
    rounds = boosting.round_errors(model, data)
    mean = data.where(~F.col(boosting.VALIDATION)).agg(F.avg("label")).first()[0]
    held = F.col(boosting.VALIDATION)
    scored = model.transform(data).agg(
        F.count_if(~held).alias("n_treino"), F.count_if(held).alias("n_validacao"),
        F.avg(F.when(held, (F.col("label") - F.col("prediction")) ** 2)).alias("_mse"),
        F.avg(F.when(held, (F.col("label") - F.lit(mean)) ** 2)).alias("_media"))
    before = F.lag("erro_validacao").over(Window.orderBy("rodada"))  # a row per round
    falls = rounds.withColumn("_antes", before).agg(
        F.bool_and(F.col("_antes").isNull() | (F.col("erro_validacao") < F.col("_antes"))).alias("erro_cai"),
        F.max_by("erro_validacao", "rodada").alias("ultimo"), F.count(F.lit(1)).alias("n")).first()
    last = F.lit(falls.ultimo)
    return scored.select(
        "n_treino", "n_validacao", F.lit(bool(falls.erro_cai and falls.n > 1)).alias("erro_cai"),
        (F.abs(last - F.col("_mse")) <= F.lit(1e-9) * F.col("_mse")).alias("erro_confere"),
        (last < F.lit(0.5) * F.col("_media")).alias("aprende"))


def _orthogonal(spark, sf_dir):
    """M3b by QR: whether the training residuals are orthogonal to each feature."""
    data, names = _assembled(spark, sf_dir)
    train = ml.training_layout(data).filter(~F.col("is_test"))
    fitted = lsq.fit(train, names)
    found = lsq.orthogonality(fitted.predict(train), names)
    return found.select("feature", (F.abs("cosseno") <= F.lit(1e-6)).alias("ortogonal"))


def _saved_model(spark, sf_dir):
    """A saved pipeline, loaded anew, scores raw panel rows; beside it the coefficients applied as columns."""
    split = materialize(_split_panel(spark, sf_dir), "ml_divisao")
    data, names, feats = ml.prepare_features(split)
    fitted = ml.train("LinearRegression", data.filter(~F.col("is_test")))
    path = _new_dir(spark, "modelo")
    ml.save_model(ml.full_model(feats, fitted), path)
    test = split.filter("is_test")
    scored = ml.predict(ml.load_model(path), test, [*test.columns])
    numeric = ml.numeric_features(split)
    by_hand = F.lit(float(fitted.intercept))
    for name, weight in zip(names, fitted.coefficients):
        if name in numeric:
            x = F.col(name).cast("double")
        else:  # <column>_<level>
            column = next(c for c in ml.CATEGORICAL if name.startswith(f"{c}_"))
            x = F.when(F.col(column) == F.lit(name[len(column) + 1:]), 1.0).otherwise(0.0)
        by_hand = by_hand + F.lit(float(weight)) * x
    same = F.abs(F.col("prediction") - by_hand) <= F.lit(1e-6) * (F.abs(by_hand) + F.lit(1.0))
    return scored.select("loja_id", "mes", same.alias("igual"))


def _model_fit(spark, sf_dir):
    """Fit of the trained models on their training rows. Least squares (from its saved form): the squares of the labels about
    their mean are those of the predictions plus those of the residuals. Forest: it leaves at most four fifths of them."""
    data, names = _assembled(spark, sf_dir)
    train = ml.training_layout(data).filter(~F.col("is_test"))
    mean = train.agg(F.avg("label")).first()[0]
    path = _new_dir(spark, "mqr")
    lsq.fit(train, names).save(spark, path)
    err, base, made = F.col("label") - F.col("prediction"), F.col("label") - F.lit(mean), F.col("prediction") - F.lit(mean)
    sst, sse, ssr = F.sum(base * base), F.sum(err * err), F.sum(made * made)
    linear = lsq.LinearFit.load(spark, path).predict(train).agg(
        F.lit("MinimosQuadradosQR").alias("modelo"), F.count(F.lit(1)).alias("n_amostras"),
        (F.abs(sst - sse - ssr) <= F.lit(1e-9) * sst).alias("ajuste_ok"))
    forest = ml.train_split("RandomForest", data, numTrees=20).transform(train).agg(
        F.lit("RandomForest").alias("modelo"), F.count(F.lit(1)).alias("n_amostras"), (sse <= F.lit(0.8) * sst).alias("ajuste_ok"))
    return linear.unionByName(forest)


def _forest_range(spark, sf_dir):
    """Test rows with the verdict that their prediction lies between the least and greatest training target."""
    data, _ = _assembled(spark, sf_dir)
    fit_rows = data.filter(~F.col("is_test"))
    model = ml.train_split("RandomForest", data)
    lo, hi = fit_rows.agg(F.min("label"), F.max("label")).first()
    return model.transform(data.filter("is_test")).select(
        "loja_id", "mes", "label", F.col("prediction").between(lo - 1e-6, hi + 1e-6).alias("dentro"))


QUERIES.update({
    "ml_dummies": _dummies_long,
    "ml_mqr_ortogonal": _orthogonal,
    "ml_modelo_salvo": _saved_model,
    "ml_modelos_ajuste": _model_fit,
    "ml_selecao_treinados": _trained_selection,
    "ml_rodadas": _boosting_rounds,
    "ml_rodadas_validacao": _boosting_summary,
    "ml_dummies_muitos_niveis": _dummies_many_levels,
    "ml_floresta_limites": _forest_range,
    "ml_split": lambda spark, sf_dir: _split_panel(spark, sf_dir).select("loja_id", "mes", "is_test"),
    "ml_metricas": _baseline_metrics,
    "ml_selecao": lambda spark, sf_dir: ml.select_best(_baseline_metrics(spark, sf_dir)),
    "ml_resumo": _resumo,
    "ml_previsao_linear": _model_predictions("LinearRegression"),
    "ml_previsao_floresta": _model_predictions("RandomForest"),
    "ml_metricas_modelos": _model_metrics,
})
