import datetime as dt

import pytest

from tests.fixtures import DQ_SCHEMA, clientes_limpo, clientes_sujo
from tillpoint.operators.quality import audit

REF = dt.date(2025, 12, 1)


def dims(a):
    return {r["dimensao"]: (r["status"], r["score"], r["ocorrencias"]) for r in a.dimensoes().collect()}


def test_limpo(spark):
    a = audit(clientes_limpo(spark), REF)
    assert dims(a) == {"completude": ("warning", 15, 1), "frescor": ("ok", 20, 0), "unicidade": ("ok", 20, 0),
                       "consistencia": ("ok", 20, 0), "acuracia": ("ok", 20, 0)}
    comp = {r["coluna"]: r["pct_nulos"] for r in a.completude_table().collect() if r["nulos"] > 0}
    assert comp == {"email_alt": 25.0}
    diag = a.diagnostico().first()
    assert diag["score_qualidade"] == 95 and diag["severidade"] == "BAIXA"


def test_sujo(spark):
    a = audit(clientes_sujo(spark), REF)
    assert dims(a) == {"completude": ("critico", 5, 3), "frescor": ("critico", 10, 1), "unicidade": ("warning", 15, 2),
                       "consistencia": ("warning", 12, 4), "acuracia": ("ok", 20, 0)}
    f = a.frescor().first()
    assert f["pct_desatualizado"] == 20.0 and f["data_mais_antiga"] == dt.date(2021, 4, 5)
    rules = {r["regra"]: r["violacoes"] for r in a.consistencia_table().collect()}
    assert rules == {"idade >= 0": 1, "email contém @": 2, "data_nascimento <= data_cadastro": 1}
    diag = a.diagnostico().first()
    assert diag["score_qualidade"] == 62 and diag["severidade"] == "ALTA"
    assert (diag["dimensoes_ok"], diag["dimensoes_warning"], diag["dimensoes_criticas"]) == (1, 2, 2)
    alerts = [(x["nivel"], x["dimensao"], x["mensagem"]) for x in a.alertas().collect()]
    assert [x[:2] for x in alerts] == [("CRITICO", "completude"), ("CRITICO", "frescor"), ("WARNING", "unicidade"),
                                       ("WARNING", "consistencia")]
    assert alerts[0][2] == "3 colunas com >5% nulos" and alerts[2][2] == "2 duplicatas encontradas"


def _one_col(spark, values, typ="string", name="cpf"):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(v,) for v in values], f"{name} {typ}")
    return df.withColumn("data_atualizacao", F.lit(dt.datetime(2025, 6, 1)))


def test_null_keys_are_equal(spark):
    a = audit(_one_col(spark, ["1", None, None, None, "2", "2"]), REF)
    assert {r["coluna"]: r["duplicatas"] for r in a.unicidade_table().collect()} == {"cpf": 3}


def test_null_email_passes(spark):
    from pyspark.sql import functions as F
    df = _one_col(spark, [None, "a@b", "ab"], name="email")
    a = audit(df, REF)
    assert {r["regra"]: r["violacoes"] for r in a.consistencia_table().collect()} == {"email contém @": 1}


def test_nan_counts_as_null_and_constant_has_no_outliers(spark):
    df = _one_col(spark, [1.0, float("nan"), 1.0, 1.0], typ="double", name="renda")
    a = audit(df, REF)
    comp = {r["coluna"]: r["nulos"] for r in a.completude_table().collect()}
    assert comp["renda"] == 1
    acc = {r["coluna"]: (r["validos"], r["outliers"]) for r in a.acuracia_table().collect()}
    assert acc == {"renda": (3, 0)}


def test_outlier_detected(spark):
    vals = [10.0] * 30 + [11.0] * 30 + [1000.0]
    a = audit(_one_col(spark, vals, typ="double", name="renda"), REF)
    acc = {r["coluna"]: (r["outliers"], r["pct"]) for r in a.acuracia_table().collect()}
    assert acc["renda"] == (1, round(100 / 61, 2))


def test_null_date_not_stale_but_counted(spark):
    df = spark.createDataFrame([(dt.datetime(2010, 1, 1),), (None,), (dt.datetime(2025, 1, 1),), (None,)],
                               "data_atualizacao timestamp")
    f = audit(df, REF).frescor().first()
    assert f["registros_desatualizados"] == 1 and f["pct_desatualizado"] == 25.0


def test_five_percent_boundary_rounds_down(spark):
    # 1 null in 19,990 rows → 0.005 %; 2,001 nulls in 40,000 rows → 5.0025 % → rounds to 5.0 → not critical
    from pyspark.sql import functions as F
    df = spark.range(40000).select(F.when(F.col("id") < 2001, F.lit(None)).otherwise(F.lit("x")).alias("telefone"),
                                   F.lit(dt.datetime(2025, 6, 1)).alias("data_atualizacao"))
    comp = {r["coluna"]: (r["pct_nulos"], r["critica"]) for r in audit(df, REF).completude_table().collect()}
    assert comp["telefone"] == (5.0, False)


def test_empty_frame(spark):
    df = spark.createDataFrame([], DQ_SCHEMA)
    d = dims(audit(df, REF))
    assert d["completude"][:2] == ("ok", 20)
    assert d["frescor"][:2] == ("critico", 10)


def test_missing_date_column_raises(spark):
    with pytest.raises(KeyError):
        audit(spark.createDataFrame([("1",)], "cpf string"), REF)


def test_freeze_gives_same_results(spark):
    lazy = audit(clientes_sujo(spark), REF)
    frozen = audit(clientes_sujo(spark), REF).freeze()
    assert lazy.report().collect() == frozen.report().collect()
    assert lazy.dimensoes().collect() == frozen.dimensoes().collect()
