import os

from pyspark.sql import functions as F

from tillpoint.plans import catalog, jobs
from tillpoint.sources import testdata as td
from tillpoint.operators.features import FEATURE_NAMES
from tillpoint.session import materialize

SF = "/root/testdata/sf0.001"


def test_feature_job_and_ignore_mode(spark, tmp_out):
    rep = jobs.run_features(spark, td.vendas(spark, SF), f"{tmp_out}/f", td.REF_DATE)
    assert rep.status == "done" and list(rep.tables) == FEATURE_NAMES and rep.rows == sum(rep.tables.values())
    for name in FEATURE_NAMES:
        assert os.path.exists(f"{tmp_out}/f/{name}/_SUCCESS")
    # mode="ignore" keeps the first write (CREATE TABLE IF NOT EXISTS)
    before = os.listdir(f"{tmp_out}/f/ticket_medio")
    rep2 = jobs.run_features(spark, td.vendas(spark, SF), f"{tmp_out}/f", td.REF_DATE, mode="ignore")
    assert rep2.status == "done" and os.listdir(f"{tmp_out}/f/ticket_medio") == before
    assert rep2.tables == rep.tables


def test_feature_job_writes_sales_once(spark, tmp_out, monkeypatch):
    """The query hands the job its sales unwritten; all that the job writes is compressed with zstd."""
    written = []
    monkeypatch.setattr(catalog, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    monkeypatch.setattr(catalog, "_new_dir", lambda spark, name: f"{tmp_out}/{name}")
    monkeypatch.setattr(jobs, "new_run_dir", lambda spark, job: f"{tmp_out}/{job}")
    assert catalog._feature_job(spark, SF).count() == 8 and written == []
    files = [f for _, _, names in os.walk(tmp_out) for f in names if f.endswith(".parquet")]
    assert len(files) >= 11 and all(f.endswith(".zstd.parquet") for f in files)


def test_feature_job_resumes_from_stage_output(spark, tmp_out):
    run_dir = f"{tmp_out}/run"
    first = jobs.run_features(spark, td.vendas(spark, SF), f"{tmp_out}/a", td.REF_DATE, run_dir=run_dir)
    written = os.stat(f"{first.details['vendas_limpo']}/_SUCCESS").st_mtime_ns
    rep = jobs.run_features(spark, td.vendas(spark, SF), f"{tmp_out}/b", td.REF_DATE, run_dir=run_dir)
    assert rep.status == "done" and rep.tables == first.tables
    assert rep.details["vendas_limpo"] == first.details["vendas_limpo"]
    assert os.stat(f"{rep.details['vendas_limpo']}/_SUCCESS").st_mtime_ns == written
    other = jobs.run_features(spark, td.vendas(spark, SF).where("loja_id = 1"), f"{tmp_out}/c", td.REF_DATE, run_dir=run_dir)
    assert other.rows < rep.rows and other.details["vendas_limpo"] != rep.details["vendas_limpo"]


def test_repaired_input_is_not_answered_with_the_old_failure(spark, tmp_out):
    run_dir = f"{tmp_out}/run"
    bad = jobs.run_features(spark, td.vendas_suja(spark, SF), f"{tmp_out}/o", td.REF_DATE, run_dir=run_dir)
    assert bad.status == "validate_fail" and not os.path.exists(run_dir)  # nothing written before the gate
    assert jobs.run_features(spark, td.vendas(spark, SF), f"{tmp_out}/o", td.REF_DATE, run_dir=run_dir).status == "done"


def test_forecast_of_other_stores_in_the_same_run_folder(spark, tmp_out):
    panel = jobs.panel_from_sales(td.vendas(spark, SF))
    small = {"RandomForest": {"numTrees": 3, "maxDepth": 2}}
    sizes = []
    for store in (1, 2, None, 1):
        rep = jobs.run_forecast(spark, panel, f"{tmp_out}/m", loja_id=store, run_dir=f"{tmp_out}/run", model_params=small)
        sizes.append((rep.details["n_treino"] + rep.details["n_teste"], rep.details["metricas"]))
        assert sizes[-1][0] == (panel if store is None else panel.where(f"loja_id = {store}")).count()
    assert sizes[0] == sizes[3] and sizes[0][1] != sizes[1][1]


def test_feature_job_stops_on_invalid_input(spark, tmp_out):
    rep = jobs.run_features(spark, td.vendas_suja(spark, SF), f"{tmp_out}/bad", td.REF_DATE)
    assert rep.status == "validate_fail" and rep.errors and rep.errors[0].startswith("nulos em categoria")
    assert not os.path.exists(f"{tmp_out}/bad")
    assert rep.details["removidas"] > 0


def test_feature_job_on_an_empty_input(spark, tmp_out):
    empty = spark.createDataFrame([], td.vendas(spark, SF).schema)
    for rows in (empty, td.vendas(spark, SF).where("loja_id < 0")):
        rep = jobs.run_features(spark, rows, f"{tmp_out}/e", td.REF_DATE, run_dir=f"{tmp_out}/r")
        assert rep.status == "done" and rep.rows == 0 and rep.details["linhas"] == 0


def test_feature_job_reads_its_input_once(spark, tmp_out):
    """The staging write counts all rows, also those that cleaning drops, and leaves only named stages."""
    rows = td.vendas(spark, SF).withColumn("quantidade", F.when(F.col("loja_id") == 1, -F.col("quantidade"))
                                           .otherwise(F.col("quantidade")))
    rep = jobs.run_features(spark, rows, f"{tmp_out}/x", td.REF_DATE, run_dir=f"{tmp_out}/s")
    dropped = rows.where("loja_id = 1").count()
    assert "validate" not in rep.stage_seconds and rep.details["linhas"] == rows.count() and rep.details["removidas"] == dropped > 0
    assert spark.read.parquet(rep.details["vendas_limpo"]).count() == rows.count() - dropped
    from tillpoint.sources.io import content_key
    assert os.listdir(f"{tmp_out}/s") == [content_key(rows)]


def test_feature_job_missing_column(spark, tmp_out):
    rep = jobs.run_features(spark, td.vendas(spark, SF).drop("regiao"), f"{tmp_out}/bad2", td.REF_DATE)
    assert rep.status == "validate_fail" and rep.errors == ["coluna ausente: regiao"]


def test_quality_job(spark):
    rep = jobs.run_quality(spark, td.clientes_dq(spark, SF), td.REF_DATE)
    assert rep.status == "done" and 0 < rep.details["score_qualidade"] <= 100
    assert rep.details["severidade"] in ("OK", "BAIXA", "MÉDIA", "ALTA")
    assert len(rep.details["dimensoes"]) == 5
    critical = {r["coluna"] for r in rep.details["colunas_criticas"]}
    assert {"email_alt", "telefone"} <= critical and set(rep.details["duplicatas"]) == {"cpf"}
    assert len(rep.details["violacoes"]) == 3 and set(rep.details["outliers"]) == {"renda", "compras_12m"}
    assert set(rep.details["frescor"]) == {"registros_desatualizados", "pct_desatualizado", "data_mais_antiga"}


def test_forecast_job(spark, tmp_out):
    panel = jobs.panel_from_sales(td.vendas(spark, SF))
    rep = jobs.run_forecast(spark, panel, f"{tmp_out}/ml",
                            model_params={"RandomForest": {"numTrees": 10, "maxDepth": 5}})
    assert rep.status == "done" and rep.details["melhor"] in ("RandomForest", "LinearRegression")
    assert rep.details["n_teste"] == -(-(rep.details["n_treino"] + rep.details["n_teste"]) * 2 // 10)
    assert os.path.exists(f"{tmp_out}/ml/modelo/metadata")
    assert rep.to_df(spark).count() == 1
    assert len(rep.details["feature_names"]) == rep.details["n_features"] and rep.details["ridge"] == 0.0


def test_partition_by_month(spark, tmp_out):
    rep = jobs.run_features(spark, td.vendas(spark, SF), f"{tmp_out}/pm", td.REF_DATE, partition_by_month=True)
    assert rep.status == "done"
    assert any(d.startswith("mes=") for d in os.listdir(f"{tmp_out}/pm/top_produtos"))
    assert not any(d.startswith("mes=") for d in os.listdir(f"{tmp_out}/pm/ticket_medio"))
    assert spark.read.parquet(f"{tmp_out}/pm/frequencia_cliente").count() == rep.tables["frequencia_cliente"]


def test_forecast_single_store(spark, tmp_out):
    panel = jobs.panel_from_sales(td.vendas(spark, SF))
    store = panel.select("loja_id").first()["loja_id"]
    rep = jobs.run_forecast(spark, panel, f"{tmp_out}/one", loja_id=store,
                            model_params={"RandomForest": {"numTrees": 5, "maxDepth": 3}})
    assert rep.status == "done"
    assert rep.details["n_features"] == 18          # constant categoricals after the filter → no dummies
    assert rep.details["n_lojas"] > 1                # summary counted before the store filter
    n = panel.filter(f"loja_id = {store}").count()
    assert rep.details["n_treino"] + rep.details["n_teste"] == n
