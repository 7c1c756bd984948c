"""One-scan outliers and shares of any number of categories, against plain versions."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from fixtures import vendas_teste
from tillpoint.operators import outliers as out
from tillpoint.operators import panel as pan
from tillpoint.operators.quality import audit
from tillpoint.operators.validate import clean_sales
from tillpoint.sources import testdata as td

SF = "/root/testdata/sf0.001"


def plain(values):
    x = [v for v in values if v is not None and not math.isnan(v)]
    if len(x) < 2 or any(math.isinf(v) for v in x) or statistics.stdev(x) == 0:
        return len(x), 0
    mean, sd = statistics.fmean(x), statistics.stdev(x)
    return len(x), sum(abs((v - mean) / sd) > 3 for v in x)


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_counts(spark, seed):
    rng = random.Random(seed)
    a = [rng.gauss(0, 1) for _ in range(3000)] + [40.0, -39.0, None, float("nan"), 0.0, -0.0]
    b = [rng.choice([1e-9, 1e12, 5.0]) if rng.random() < 0.01 else 7.0 for _ in a]
    c = [float(2 ** rng.randint(-3, 9)) for _ in a]
    d = [5.0] * len(a)
    e = [None] * len(a)
    f = [rng.random() for _ in a[1:]] + [float("inf")]
    names = "abcdef"
    df = spark.createDataFrame(list(zip(a, b, c, d, e, f)), ", ".join(f"{k} double" for k in names)).repartition(3)
    got = {r.coluna: (r.validos, r.outliers) for r in out.outliers(df, list(names)).collect()}
    assert got == {k: plain(v) for k, v in zip(names, (a, b, c, d, e, f))}
    assert {r.outliers for r in out.outliers(df.where("false"), ["a", "b"]).collect()} == {0}


def test_cells_hold_their_numbers(spark):
    rng = random.Random(9)
    xs = [0.0, -0.0, 1.0, 2.0, 0.5, 1 - 2**-53, 2 - 2**-52, 4.0, 1023.9999999999999, 1024.0, 1e300, 1e-300, 8.0, 7.999999999999999]
    xs += [math.ldexp(rng.uniform(0.5, 1), rng.randint(-500, 500)) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for x in xs for v in (x, -x)], "x double")
    rows = df.select("x", out._cell(F.col("x")).alias("cell")).collect()
    for r in rows:
        low, high = out.cell_range(r.cell)
        assert low <= r.x <= high
    by_value = [r.cell for r in sorted(rows, key=lambda r: r.x)]
    assert by_value == sorted(by_value)


def test_same_as_the_audit_and_one_full_scan(spark, tmp_out):
    df = td.clientes_dq(spark, SF)
    df.write.parquet(f"{tmp_out}/c")
    df = spark.read.parquet(f"{tmp_out}/c")
    want = {r.coluna: tuple(r) for r in audit(df, td.REF_DATE).acuracia_table().collect()}
    result = out.outliers(df, ["renda", "compras_12m"])
    assert {r.coluna: tuple(r) for r in result.collect()} == want
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    scans = [x for x in result._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert all("GreaterThanOrEqual" in x and "LessThanOrEqual" in x for x in scans)  # the second look is a range of the scan
    p = out.histograms(df, ["renda", "compras_12m"])._jdf.queryExecution().executedPlan().toString()
    assert p.count("FileScan") == 1


# ---- shares in long form ---------------------------------------------------------------------------------------------
def test_long_shares_of_a_small_frame(spark):
    sales = clean_sales(vendas_teste(spark))
    sales = sales.unionByName(sales.limit(1).withColumn("categoria", F.lit(None).cast("string")).withColumn("loja_id", F.lit(12)))
    got = {(r.loja_id, r.mes, r.categoria): r.share for r in pan.long_shares(sales).collect()}
    assert got == {(11, "2024-03", "Padaria"): 0.5, (11, "2024-03", "Bebidas"): 0.5, (11, "2024-04", "Limpeza"): 0.6,
                   (11, "2024-04", "Bebidas"): 0.4, (12, "2024-03", "Limpeza"): 0.8, (12, "2024-04", "Limpeza"): 0.5,
                   (12, "2024-04", "Padaria"): 0.5}
    main = {r.loja_id: r.categoria_principal for r in pan.main_category(sales).collect()}
    assert main == {11: "Bebidas", 12: "Limpeza"}  # 90 and 90 in store 11: the first by name


def test_sparse_shares_equal_the_columns(spark):
    sales = clean_sales(td.vendas(spark, SF))
    levels, rows = pan.sparse_shares(sales)
    names = {r.posicao: r.nivel for r in levels.collect()}
    wide = {(r.loja_id, r.mes): r for r in pan.build_panel(sales, keep_last=True).collect()}
    main = {r.loja_id: r.categoria_principal for r in pan.main_category(sales).collect()}
    assert len(names) == 6 and rows.count() == len(wide)
    for r in rows.collect():
        assert r.posicoes == sorted(r.posicoes) and r.tamanho == 6
        given = dict(zip((names[p] for p in r.posicoes), r.valores))
        w = wide[r.loja_id, r.mes]
        assert {c: given.get(c, 0.0) for c in names.values()} == {c: w[pan.share_column(c)] for c in names.values()}
        assert main[r.loja_id] == w.categoria_principal


def test_the_levels_of_sparse_shares_are_not_broadcast(spark):
    sales = clean_sales(vendas_teste(spark)).withColumn("categoria", F.col("produto_id").cast("string"))
    _, rows = pan.sparse_shares(sales)
    assert "BroadcastHashJoin" not in rows._jdf.queryExecution().executedPlan().toString()
