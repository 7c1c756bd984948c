import datetime as dt

import pytest

from tests.fixtures import vendas_teste
from tillpoint.operators import features as feat
from tillpoint.operators.validate import clean_sales


@pytest.fixture(scope="module")
def vendas(spark):
    return clean_sales(vendas_teste(spark)).cache()


def rows(df, *keys):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: tuple(r[k] for k in keys))


def test_ticket_medio(vendas):
    table = feat.ticket_medio(vendas)
    assert table.columns == ["data_venda", "loja_id", "receita_total", "n_vendas", "ticket_medio", "clientes_unicos"]
    out = [tuple(r.values()) for r in rows(table, "loja_id", "data_venda")]
    assert out == [(dt.date(2024, 3, 4), 11, 40.0, 2, 20.0, 2), (dt.date(2024, 3, 5), 11, 20.0, 1, 20.0, 1),
                   (dt.date(2024, 4, 2), 11, 150.0, 2, 75.0, 2), (dt.date(2024, 3, 10), 12, 40.0, 1, 40.0, 1),
                   (dt.date(2024, 4, 13), 12, 20.0, 2, 10.0, 1)]


def test_ticket_medio_cutoff(vendas):
    out = feat.ticket_medio(vendas, dt.date(2024, 3, 5)).collect()
    assert sorted(r["data_venda"].day for r in out) == [4, 5]


def test_frequencia_cliente(vendas):
    out = {(r["cliente_id"], r["mes"]): (r["compras"], r["gasto_total"], r["lojas_visitadas"])
           for r in feat.frequencia_cliente(vendas).collect()}
    assert out == {(71, "2024-03"): (3, 70.0, 2), (72, "2024-03"): (1, 30.0, 1), (73, "2024-04"): (1, 90.0, 1),
                   (71, "2024-04"): (1, 60.0, 1), (74, "2024-04"): (2, 20.0, 1)}


def test_share_categoria(vendas):
    out = {(r["loja_id"], r["categoria"]): (r["share_pct"], r["receita_categoria"], r["margem_categoria"])
           for r in feat.share_categoria(vendas).collect()}
    assert out == {(11, "Padaria"): (14.29, 30.0, 12.0), (11, "Bebidas"): (42.86, 90.0, 36.0),
                   (11, "Limpeza"): (42.86, 90.0, 45.0), (12, "Limpeza"): (83.33, 50.0, 25.0),
                   (12, "Padaria"): (16.67, 10.0, 6.0)}


def test_crescimento_mom(vendas):
    out = {(r["loja_id"], r["mes"]): r["crescimento_mom_pct"] for r in feat.crescimento_mom(vendas).collect()}
    assert out == {(11, "2024-03"): None, (11, "2024-04"): 150.0, (12, "2024-03"): None, (12, "2024-04"): -50.0}


def test_recencia_exact(vendas):
    out = {r["cliente_id"]: r["dias_desde_ultima"]
           for r in feat.recencia_cliente(vendas, dt.date(2024, 4, 20)).collect()}
    assert out == {71: 18, 72: 47, 73: 18, 74: 7}


def test_tendencia_7d(vendas):
    out = rows(feat.tendencia_7d(vendas).filter("loja_id = 11"), "data_venda")
    assert [r["media_movel_7d"] for r in out] == [40.0, 30.0, 70.0]
    assert [r["desvio_pct"] for r in out] == [0.0, -33.33, 114.29]


def test_sazonalidade(vendas):
    out = {(r["loja_id"], r["dia_da_semana"]): (r["dia_semana"], r["receita_media"], r["indice_sazonal"])
           for r in feat.sazonalidade_dia(vendas).collect()}
    assert out == {(11, "Segunda"): (1, 40.0, 0.38), (11, "Terça"): (2, 170.0, 1.62),
                   (12, "Domingo"): (0, 40.0, 1.33), (12, "Sábado"): (6, 20.0, 0.67)}


def test_top_produtos_ties_go_to_the_lower_id(vendas):
    out = [(r["loja_id"], r["mes"], r["produto_id"], r["rank"])
           for r in rows(feat.top_produtos(vendas), "loja_id", "mes", "rank")]
    assert out == [(11, "2024-03", 501, 1), (11, "2024-03", 502, 2), (11, "2024-04", 503, 1), (11, "2024-04", 502, 2),
                   (12, "2024-03", 503, 1), (12, "2024-04", 501, 1), (12, "2024-04", 503, 2)]


def test_build_features(vendas):
    tables = feat.build_features(vendas, dt.date(2024, 4, 20))
    assert list(tables) == feat.FEATURE_NAMES
    assert [t.count() for t in tables.values()] == [5, 5, 5, 4, 4, 5, 4, 7]


@pytest.mark.parametrize("kind", ["double", "decimal(20,3)"])
def test_amounts_below_a_cent_are_summed_unrounded(spark, kind):
    df = spark.range(9).selectExpr("1L as loja_id", "'x' as categoria", f"cast(0.004 as {kind}) as valor_total",
                                   f"cast(0.001 as {kind}) as custo", "id as cliente_id",
                                   "date'2024-03-04' as data_venda", "id as produto_id")
    assert feat.crescimento_mom(df).first()["receita"] == pytest.approx(0.036)
    assert feat.share_categoria(df).first()["margem_categoria"] == 0.03
    assert feat.ticket_medio(df).first()["receita_total"] == pytest.approx(0.036)


def test_top_k_plan_limits_before_shuffle(vendas):
    plan = feat.top_produtos(vendas)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan


def test_shared_aggregates_give_identical_tables(spark):
    from tillpoint.session import materialize
    from tillpoint.sources import testdata as td
    from tillpoint.operators.validate import clean_sales
    v = clean_sales(td.vendas(spark, "/root/testdata/sf0.001"))
    lazy = feat.build_features(v, td.REF_DATE)
    shared = feat.build_features(v, td.REF_DATE, share=materialize)
    for name in feat.FEATURE_NAMES:
        assert lazy[name].columns == shared[name].columns
        assert lazy[name].exceptAll(shared[name]).count() == 0 and shared[name].exceptAll(lazy[name]).count() == 0


def test_presentation_order(vendas):
    out = feat.presentation_order("share_categoria", feat.share_categoria(vendas)).collect()
    keys = [(r["loja_id"], -r["share_pct"]) for r in out]
    assert keys == sorted(keys)
    rec = feat.presentation_order("recencia_cliente", feat.recencia_cliente(vendas, dt.date(2024, 4, 20))).collect()
    assert [r["dias_desde_ultima"] for r in rec] == sorted(r["dias_desde_ultima"] for r in rec)
