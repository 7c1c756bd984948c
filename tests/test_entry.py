"""Driver contract and SQL-oracle parity on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FAST = ["ticket_medio", "share_categoria", "crescimento_mom", "tendencia_7d", "top_produtos", "validacao_relatorio",
        "dq_dimensoes", "dq_alertas", "painel_target", "painel_fora_da_lista", "painel_regioes",
        "share_categoria_fracoes", "ml_split", "ml_metricas", "ml_dummies_muitos_niveis",
        "top_produtos_resumo", "top_produtos_rede", "vendas_por_sql", "ml_largura_loja", "features_guardar_primeira"]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "ticket_medio" in df.columns


def test_every_sql_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    rows_only = {n for n in set(E.queries()) - set(E.oracle_sql()) if n.startswith("ml_")}
    assert rows_only == {"ml_previsao_linear", "ml_previsao_floresta", "ml_metricas_modelos", "ml_rodadas"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(rows):
    def key(v):
        return (v is None, str(v))
    return sorted((tuple(sorted(r.items())) for r in rows), key=lambda t: [key(v) for _, v in t])


@pytest.mark.parametrize("name", FAST)
def test_oracle_parity(spark, duck, name):
    s = E.queries()[name](spark, SF).toPandas()
    d = duck.sql(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    cols = sorted(s.columns)
    import pandas as pd
    for frame in (s, d):
        for c in cols:
            if frame[c].dtype == object:
                frame[c] = frame[c].map(lambda v: float(v) if type(v).__name__ == "Decimal" else v)
                if frame[c].map(lambda v: hasattr(v, "year")).any():
                    frame[c] = pd.to_datetime(frame[c])
    a = s[cols].sort_values(cols).reset_index(drop=True)
    b = d[cols].sort_values(cols).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False, check_exact=True)
