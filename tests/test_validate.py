import datetime as dt

from tests.fixtures import vendas_invalidas, vendas_teste
from tillpoint.operators import validate as val


def test_valid_schema(spark):
    r = val.schema_report(vendas_teste(spark)).first()
    assert r["valido"] and r["problemas"] == [] and r["linhas"] == 8 and r["colunas"] == 11
    assert r["removidas"] == 0 and dict(r["nulos_por_coluna"]) == {}


def test_invalid_schema(spark):
    r = val.schema_report(vendas_invalidas(spark)).first()
    assert not r["valido"]
    assert sorted(r["problemas"]) == ["nulos em cliente_id: 1", "nulos em loja_id: 1", "nulos em regiao: 2"]
    assert dict(r["nulos_por_coluna"]) == {"loja_id": 1, "cliente_id": 1, "regiao": 2}


def test_missing_column(spark):
    df = vendas_teste(spark).drop("regiao", "custo")
    r = val.schema_report(df).first()
    assert not r["valido"]
    assert r["problemas"][:2] == ["coluna ausente: custo", "coluna ausente: regiao"]


def test_cleaning(spark):
    clean = val.clean_sales(vendas_invalidas(spark)).collect()
    assert sorted(r["quantidade"] for r in clean) == [1, 4]
    assert isinstance(clean[0]["data_venda"], dt.date)
    assert len(val.clean_sales(vendas_teste(spark)).collect()) == 8
    r = val.schema_report(vendas_invalidas(spark)).first()
    assert r["removidas"] == 2


def test_nan_is_removed_and_counted(spark):
    df = vendas_teste(spark).limit(2).union(
        spark.createDataFrame([(dt.datetime(2025, 1, 1), 1, 1, "x", 1, float("nan"), 10.0, 1.0, 1, "a", "b")],
                              vendas_teste(spark).schema))
    assert val.clean_sales(df).count() == 2
    r = val.schema_report(df).first()
    assert dict(r["nulos_por_coluna"]) == {"valor_unitario": 1}


def test_null_counts_long_form(spark):
    out = {r["coluna"]: r["nulos"] for r in val.null_counts(vendas_invalidas(spark)).collect()}
    assert out["regiao"] == 2 and out["produto_id"] == 0 and len(out) == 11


def test_only_store_keeps_zero(spark):
    df = vendas_teste(spark)
    assert val.only_store(df, None).count() == 8
    assert val.only_store(df, 12).count() == 3
    assert val.only_store(df, 0).count() == 0
