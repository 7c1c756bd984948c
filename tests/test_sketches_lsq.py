"""Customer sketches within their stated bound; least squares by QR against plain versions, saved and loaded."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from fixtures import vendas_teste
from tillpoint.operators import features as feat
from tillpoint.operators import least_squares as lsq
from tillpoint.operators import sketches as sk
from tillpoint.operators.validate import clean_sales
from tillpoint.session import materialize


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- sketches ----------------------------------------------------------------------------------------------------
def test_levels_of_a_small_frame(spark):
    sales = clean_sales(vendas_teste(spark))
    sales = sales.unionByName(sales.limit(1).withColumn("cliente_id", F.lit(None).cast("bigint")))
    got = {(r.nivel, r.periodo, r.loja_id): r.clientes for r in sk.exact_levels(sales, materialize).collect()}
    assert got["rede", None, None] == 4 and got["loja", None, 11] == 3 and got["rede_mes", "2024-03", None] == 2
    assert got["loja_mes", "2024-04", 12] == 1 and got["loja_dia", "2024-03-04", 11] == 2 and len(got) == 5 + 4 + 2 + 2 + 1
    assert sk.exact_levels(sales.where("false"), materialize).where("nivel <> 'rede'").count() == 0


def test_rolled_up_sketches_keep_their_bound(spark):
    """200 stores and days of up to 30,000 customers, many shared: every level's error is within the bound."""
    sales = spark.range(400_000).select(
        F.date_add(F.lit("2024-01-30").cast("date"), (F.col("id") % 5).cast("int")).alias("data_venda"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).cast("bigint").alias("loja_id"),
        F.pmod(F.xxhash64("id"), F.lit(90_000)).alias("cliente_id"))
    exact = sk.exact_levels(sales, materialize)
    daily = materialize(sk.daily_sketches(sales), "esbocos")
    assert "cliente_id" not in daily.columns  # coarser levels read no sale
    rows = sk.compare_levels(exact, sk.estimated_levels(daily), sk.error_bound()).collect()
    assert all(r.dentro_do_limite for r in rows) and max(r.clientes for r in rows) > 80_000
    tight = sk.compare_levels(exact, sk.estimated_levels(daily), 1e-6).collect()
    assert not all(r.dentro_do_limite for r in tight)
    assert sk.error_bound(14) == sk.error_bound(12) / 2 < 0.04


def test_month_is_no_key_of_the_daily_levels(spark):
    saved = {}
    sk.exact_levels(clean_sales(vendas_teste(spark)), lambda df, name: saved.setdefault(name, df))
    for df in (saved["clientes-loja_dia"], sk.daily_sketches(clean_sales(vendas_teste(spark)))):
        assert "mes" in df.columns
        assert all("mes" not in line for line in plan(df).splitlines() if "Exchange hashpartitioning" in line)


def test_distinct_counts_shuffle_keys_only(spark):
    sales = clean_sales(vendas_teste(spark))
    for df in (feat.daily_store(sales), feat.customer_month(sales)):
        p = plan(df)
        spread = [line for line in p.splitlines() if "Exchange hashpartitioning" in line]
        assert len(spread) == 2 and "Expand" not in p and "Join" not in p  # sums by the keys; keys with values on their own
        pairs = p[p.index(spread[1]):]
        assert "sum(" not in pairs and "max(" not in pairs
    from tillpoint.operators.reports import perfil_vendas
    assert "Expand" not in plan(perfil_vendas(sales))


# ---- least squares -------------------------------------------------------------------------------------------------
def frame(spark, x, y, parts=5):
    return spark.createDataFrame(
        [(Vectors.dense(a), float(b)) for a, b in zip(x.tolist(), y.tolist())], ["features", "label"]).repartition(parts)


@pytest.mark.parametrize("parts", [1, 40])
def test_against_a_plain_solver(spark, parts):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 6)) * [1, 1e6, 1e-6, 10, 100, 1]
    y = x @ [3, 2e-6, 1e5, -1, 0.25, 0] + 7 + rng.normal(size=700)
    names = [f"x{i}" for i in range(6)]
    fitted = lsq.fit(frame(spark, x, y, parts), names)
    want = np.linalg.lstsq(np.column_stack([np.ones(700), x]), y, rcond=None)[0]
    assert np.allclose([fitted.intercept, *fitted.coefficients], want, rtol=1e-7) and fitted.rank == 7 and fitted.n == 700


def test_nearly_singular_features(spark, tmp_out):
    """Rounded shares sum to almost one: normal equations lose the orthogonality, the QR keeps it."""
    rng = np.random.default_rng(2)
    shares = np.round(rng.dirichlet(np.ones(6), 500), 4)
    x = np.column_stack([shares, rng.normal(1e5, 1e4, 500)])
    y = shares @ [9, 1, 4, 2, 8, 3] + x[:, -1] * 1e-3 + rng.normal(0, 0.1, 500)
    names = [f"x{i}" for i in range(7)]
    data = frame(spark, x, y)
    fitted = lsq.fit(data, names)
    cosines = [abs(r.cosseno) for r in lsq.orthogonality(fitted.predict(data), names).collect()]
    assert len(cosines) == 8 and max(cosines) < 1e-9
    fitted.save(spark, f"{tmp_out}/m")
    loaded = lsq.LinearFit.load(spark, f"{tmp_out}/m")
    assert loaded == fitted and loaded.names == tuple(names)
    hand = np.column_stack([np.ones(500), x]) @ [fitted.intercept, *fitted.coefficients]
    assert np.allclose(sorted(r.prediction for r in loaded.predict(data).collect()), sorted(hand))


def test_dependent_constant_and_missing(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=60)
    x = np.column_stack([a, 2 * a, np.ones(60), np.zeros(60)])
    y = 5 * a + 1
    names = ["a", "b", "one", "zero"]
    fitted = lsq.fit(frame(spark, x, y), names)
    assert fitted.rank == 2 and np.allclose(np.column_stack([np.ones(60), x]) @ [fitted.intercept, *fitted.coefficients], y)
    x[0, 0] = np.nan
    again = lsq.fit(frame(spark, x, y).withColumn("label", F.when(F.col("label") != 77.0, F.col("label"))), names)
    assert again.n == 59 and np.allclose(np.column_stack([np.ones(59), x[1:]]) @ [again.intercept, *again.coefficients], y[1:])
    none = lsq.fit(frame(spark, x, y).where("false"), names)
    assert none.n == 0 and none.coefficients == (0.0,) * 4


def test_prediction_as_columns(spark):
    fitted = lsq.LinearFit(("a", "b"), (2.0, -1.0), 0.5, 3, 10)
    df = spark.createDataFrame([(1.0, 4), (2.0, 0)], "a double, b int")
    assert [r.p for r in df.select(fitted.column([F.col("a"), F.col("b")]).alias("p")).collect()] == [-1.5, 4.5]
