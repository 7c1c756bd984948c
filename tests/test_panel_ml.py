import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillpoint.operators import ml
from tillpoint.operators.panel import build_panel, monthly, store_regions
from tillpoint.plans.catalog import QUERIES

from functools import reduce


def sales_for_store(spark, loja, months, base=1000, categoria="A", regiao="R"):
    from decimal import Decimal
    rows = []
    for i, m in enumerate(months):
        amount = Decimal(base * (i + 1))
        rows.append((dt.date(2024, m, 3), loja, 1, categoria, 1, float(amount), amount, amount * Decimal("0.6"),
                     loja * 100 + i, "x", regiao))
    return spark.createDataFrame(rows, "data_venda date, loja_id bigint, produto_id bigint, categoria string, "
                                       "quantidade bigint, valor_unitario double, valor_total decimal(18,2), "
                                       "custo decimal(18,2), cliente_id bigint, canal_venda string, regiao string")


def test_panel_windows(spark):
    p = build_panel(sales_for_store(spark, 7, range(1, 9)), ["A", "B"], keep_last=True).orderBy("mes").collect()
    assert len(p) == 8
    r = [x["receita"] for x in p]
    assert [x["target"] for x in p] == r[1:] + [None]
    assert [x["crescimento_3m"] for x in p[:3]] == [0.0, 0.0, 0.0]
    assert p[3]["crescimento_3m"] == round((r[3] / r[0] - 1) * 100, 2)
    assert p[5]["crescimento_6m"] == 0.0  # no look-ahead at i = 5
    assert p[6]["crescimento_6m"] == round((r[6] / r[0] - 1) * 100, 2)
    assert p[1]["ticket_3m_avg"] == 0.0 and p[2]["ticket_3m_avg"] == round((r[0] + r[1] + r[2]) / 3, 2)
    assert p[0]["share_a"] == 1.0 and p[0]["share_b"] == 0.0
    assert p[0]["categoria_principal"] == "A" and p[0]["custo_pct"] == 0.6
    assert build_panel(sales_for_store(spark, 7, range(1, 9)), ["A", "B"]).count() == 7


def test_sales_are_not_sorted_for_the_panel(spark):
    """No aggregate over all sales is a sort aggregate; the regions' one sorts each store's distinct regions, a written table."""
    sales = sales_for_store(spark, 1, range(1, 5))
    assert "SortAggregate" not in monthly(sales, ["A"])._jdf.queryExecution().executedPlan().toString()
    regions = store_regions(sales)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in regions and "regioes-" in regions


def test_region_belongs_to_the_store(spark):
    two = sales_for_store(spark, 1, range(1, 5), regiao="Sul").union(
        sales_for_store(spark, 1, range(2, 6), base=50, regiao="Norte"))
    none = sales_for_store(spark, 2, range(1, 4), regiao=None)
    nobody = sales_for_store(spark, 3, range(1, 3)).withColumn("loja_id", F.lit(None).cast("bigint"))
    p = build_panel(two.union(none).union(nobody), keep_last=True).orderBy("loja_id", "mes").collect()
    assert [(r["loja_id"], r["mes"], r["regiao"]) for r in p] == [
        (None, "2024-01", "R"), (None, "2024-02", "R"), *[(1, f"2024-0{m}", "Norte") for m in range(1, 6)],
        *[(2, f"2024-0{m}", None) for m in range(1, 4)]]
    store = [r for r in p if r["loja_id"] == 1]
    assert [r["receita"] for r in store] == [1000.0, 2050.0, 3100.0, 4150.0, 200.0]
    assert [r["target"] for r in store] == [2050.0, 3100.0, 4150.0, 200.0, None]
    assert all(r["n_clientes"] >= 1 for r in p)


def test_categories_outside_the_list(spark):
    sales = sales_for_store(spark, 1, [1], categoria="Z").union(sales_for_store(spark, 1, [1], base=500, categoria="A"))
    listed = build_panel(sales, ["A", "B"], keep_last=True).first()
    assert (listed["share_a"], listed["share_b"], listed["share_outras"]) == (0.3333, 0.0, 0.6667)
    assert listed["categoria_principal"] == "Outras"
    learned = build_panel(sales, keep_last=True).first()
    assert (learned["share_a"], learned["share_z"], learned["categoria_principal"]) == (0.3333, 0.6667, "Z")
    without = build_panel(sales.withColumn("categoria", F.lit(None).cast("string")), keep_last=True).first()
    assert without["receita"] == 1500.0 and without["categoria_principal"] is None


@pytest.fixture(scope="module")
def painel_lojas(spark):
    """Six stores with nine months each, built from sales: two small, two medium and two large ones."""
    stores = [sales_for_store(spark, k, range(1, 11), base=b)
              for k, b in enumerate([100, 120, 1000, 1010, 2000, 2100], start=1)]
    from tillpoint.session import materialize
    return materialize(build_panel(reduce(lambda a, b: a.union(b), stores)), "painel_lojas")


def test_prepare_features_shape(painel_lojas):
    df, names, _ = ml.prepare_features(painel_lojas)
    assert df.count() == 54 and names == ml.BASE_FEATURES + ["share_a", "porte_Médio", "porte_Pequeno"]
    assert {r["features"].size for r in df.select("features").collect()} == {15}
    one, names1, _ = ml.prepare_features(painel_lojas, loja_id=3)
    assert one.count() == 9 and names1 == ml.BASE_FEATURES + ["share_a"]  # one size only: no dummies


def test_first_level_null_and_unseen_values_are_all_zero(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,), ("b",)], "regiao string")
    enc = ml.fit_dummies(df, ["regiao", "porte"])
    assert enc.names() == ["regiao_b", "regiao_c"]
    other = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("z",)], "regiao string")
    out = {}
    for r in ml.dummies_long(other, enc, ["regiao"]).collect():
        out.setdefault(r["regiao"], {})[r["coluna"]] = r["valor"]
    zero = {"regiao_b": 0.0, "regiao_c": 0.0}
    assert out == {"a": zero, None: zero, "z": zero, "b": zero | {"regiao_b": 1.0}, "c": zero | {"regiao_c": 1.0}}
    assert sorted(tuple(r) for r in ml.dummies_long(other, enc, ["regiao"], nonzero=True).collect()) == [
        ("b", "regiao_b", 1.0), ("c", "regiao_c", 1.0)]
    nothing = ml.fit_dummies(df.where("regiao is null"), ["regiao"])
    assert nothing.names() == [] and ml.dummies_long(df, nothing, ["regiao"]).count() == 0


def test_more_levels_than_any_former_limit(spark):
    df = spark.range(4000).select(F.format_string("n%05d", "id").alias("regiao"))
    enc = ml.fit_dummies(df, ["regiao"])
    assert len(enc.names()) == 3999 and ml.dummies_long(df, enc, ["regiao"], nonzero=True).count() == 3999


def test_levels_as_a_table(spark, monkeypatch):
    values = [f"n{i * 7919 % 3000}" for i in range(3000)] + ["é", "", "n5", None]
    df = spark.createDataFrame(list(enumerate(values)), "k long, c string").repartition(5)
    levels = ml.level_table(df, "c")
    want = sorted({v for v in values if v is not None})
    assert {r.nivel: r.posicao for r in levels.collect()} == {v: i for i, v in enumerate(want)}
    other = spark.createDataFrame([(1, "é"), (1, "é"), (2, "n7"), (3, None), (4, "unseen"), (5, "")], "k long, c string")
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    assert rows(ml.dummies_by_table(other, "c", levels, ["k"])) == [(1, "c_é", 1.0), (1, "c_é", 1.0), (2, "c_n7", 1.0)]
    for table in (other, other.where("k = 3"), other.where("k = 2"), other.where("false")):
        by_table = ml.dummies_by_table(table, "c", ml.level_table(table, "c"), ["k"])
        assert rows(by_table) == rows(ml.dummies_long(table, ml.fit_dummies(table, ["c"]), ["k"], nonzero=True))

    def gathers(*_):
        raise AssertionError("levels pass through the driver")
    monkeypatch.setattr(ml, "fit_dummies", gathers)
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    assert QUERIES["ml_dummies_muitos_niveis"](spark, "/root/testdata/sf0.001").count() == orders - 1


@pytest.mark.parametrize("n,test", [(0, 0), (1, 1), (37, 8), (1000, 200), (3001, 601)])
def test_exact_split_sizes(spark, n, test):
    df = spark.range(n).select(F.col("id").alias("loja_id"), F.lit("2024-05").alias("mes"))
    s = ml.exact_split(df)
    assert s.count() == n and s.where("is_test").count() == test


def test_split_does_not_depend_on_partitions_even_with_equal_keys(spark):
    df = spark.range(100).select(F.lit(5).alias("loja_id"), F.lit("2024-05").alias("mes"), F.col("id").alias("valor"))
    picked = [sorted(r["valor"] for r in ml.exact_split(d).where("is_test").collect())
              for d in (df.coalesce(1), df.repartition(4, "valor"), df.repartition(16))]
    assert len(picked[0]) == 20 and picked[0] == picked[1] == picked[2]


def _vectors(df, cols):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=cols, outputCol="features").transform(df)


def test_linear_fit_finds_the_plane(spark):
    rows = [(7 - 0.5 * u + 4.0 * v, float(u), float(v)) for u in range(6) for v in range(5)]
    data = _vectors(spark.createDataFrame(rows, "label double, u double, v double"), ["u", "v"])
    model = ml.train("LinearRegression", data)
    assert list(model.coefficients) == pytest.approx([-0.5, 4.0]) and model.intercept == pytest.approx(7.0)
    assert model.getRegParam() == 0.0
    m = ml.regression_metrics(model.transform(data)).first()
    assert (m["r2"], m["rmse"], m["mae"], m["n_amostras"]) == (1.0, 0.0, 0.0, 30)


def test_linear_fit_with_fewer_rows_than_features(spark):
    data = _vectors(spark.createDataFrame([(1.0, 1.0, 0.0, 2.0), (3.0, 2.0, 1.0, 4.0)],
                                          "label double, a double, b double, c double"), ["a", "b", "c"])
    model = ml.train("LinearRegression", data)
    assert model.getRegParam() == ml.TINY_RIDGE
    assert [r["prediction"] for r in model.transform(data).collect()] == pytest.approx([1.0, 3.0], abs=1e-3)


def test_forest_does_not_depend_on_the_cluster(spark):
    rows = [(k, "2024-01", float(k % 11), float(k % 7), float((k * k) % 13)) for k in range(200)]
    df = _vectors(spark.createDataFrame(rows, "loja_id long, mes string, a double, b double, label double"), ["a", "b"])
    sums = []
    for parts in (2, 8):
        fit = ml.training_layout(df.repartition(parts))
        model = ml.train("RandomForest", fit, numTrees=5, maxDepth=4)
        sums.append([r["prediction"] for r in model.transform(df.orderBy("loja_id")).collect()])
    assert sums[0] == sums[1]


def test_random_forest_fits(spark):
    rnd = random.Random(1)
    rows = [(float(i % 7), float(i % 7) * 3 + rnd.random()) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, label double")
    from pyspark.ml.feature import VectorAssembler
    data = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    model = ml.train("RandomForest", data)
    assert model.getNumTrees == 100 and len(model.transform(data).take(5)) == 5


def test_select_best(spark):
    schema = "ordem int, modelo string, r2 double"
    m = spark.createDataFrame([(1, "constante", -0.2), (2, "reta", 0.31), (3, "arvore", 0.3), (4, "vazio", None)], schema)
    assert ml.select_best(m).first()["modelo"] == "reta"
    tie = spark.createDataFrame([(2, "depois", 0.5), (1, "antes", 0.5)], schema)
    assert ml.select_best(tie).first()["modelo"] == "antes"


def test_save_load_predict(spark, painel_lojas, tmp_out):
    df, names, feats = ml.prepare_features(painel_lojas)
    full = ml.full_model(feats, ml.train("LinearRegression", df))
    ml.save_model(full, f"{tmp_out}/modelo")
    unseen = painel_lojas.withColumn("porte", F.lit("Enorme"))
    for rows in (painel_lojas, unseen):
        a = sorted(r["prediction"] for r in ml.predict(full, rows).collect())
        b = sorted(r["prediction"] for r in ml.predict(ml.load_model(f"{tmp_out}/modelo"), rows).collect())
        assert len(a) == 54 and a == pytest.approx(b)


def test_optional_gradient_boosting(spark):
    rows = [(float(i % 5), float(i % 5) * 2.0) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, label double")
    from pyspark.ml.feature import VectorAssembler
    data = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    gbt = ml.gradient_boosting()
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize()) == (100, 6, 0.1)
    model = ml.train("GradientBoosting", data, maxIter=5)
    assert ml.regression_metrics(model.transform(data)).first()["r2"] > 0.9


def test_memory_strings():
    assert ml._memory_mb("16g") == 16384 and ml._memory_mb("512m") == 512 and ml._memory_mb("2048") == 2048
    assert ml._memory_mb("1gb") == 1024 and ml._memory_mb("1t") == 1024 * 1024


def test_training_partitions_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ml, "TRAIN_ROWS", 100)
    df = spark.range(2450).select(F.col("id").alias("loja_id"), F.lit("m").alias("mes"), F.rand(3).alias("label"))
    df = df.localCheckpoint()
    places = [ml.training_layout(df.repartition(n)).withColumn("p", F.spark_partition_id()) for n in (2, 7)]
    assert [p.rdd.getNumPartitions() for p in places] == [25, 25] and places[0].exceptAll(places[1]).isEmpty()
    assert places[0].count() == 2450 and places[0].groupBy("p").count().agg(F.max("count")).first()[0] < 200
    assert ml.training_layout(df.limit(50)).rdd.getNumPartitions() == ml.TRAIN_PARTITIONS
    assert ml.training_layout(df, partitions=3).rdd.getNumPartitions() == 3


def test_training_partitions_grow_when_there_are_many(spark, monkeypatch):
    monkeypatch.setattr(ml, "TRAIN_ROWS", 10)
    monkeypatch.setattr(ml, "TRAIN_MANY", 12)
    monkeypatch.setattr(ml, "TRAIN_MOST_ROWS", 1000)
    df = spark.range(2450).select(F.col("id").alias("loja_id"), F.lit("m").alias("mes"), F.lit(1.0).alias("label"))
    assert ml.training_layout(df).rdd.getNumPartitions() == 12
    assert ml.training_layout(df.limit(95)).rdd.getNumPartitions() == 10
    assert ml.training_partitions(20_000) == 20


def test_a_large_forest_keeps_no_node_ids_and_is_the_same(spark, monkeypatch, tmp_out):
    rows = [(k, "2024-01", float(k % 11), float(k % 7), float((k * k) % 13), k % 5 == 0) for k in range(300)]
    df = _vectors(spark.createDataFrame(rows, "loja_id long, mes string, a double, b double, label double, is_test boolean"), ["a", "b"])
    df.write.parquet(f"{tmp_out}/dados")
    data, found = spark.read.parquet(f"{tmp_out}/dados"), []
    for limit in (1000, 100):
        monkeypatch.setattr(ml, "NODE_ID_ROWS", limit)
        model = ml.train_split("RandomForest", data, numTrees=5, maxDepth=4)
        assert model.getCacheNodeIds() == (limit == 1000)
        found.append([r["prediction"] for r in model.transform(data.orderBy("loja_id")).collect()])
    whole = ml.train("RandomForest", ml.training_layout(data).where("NOT is_test"), numTrees=5, maxDepth=4)
    found.append([r["prediction"] for r in whole.transform(data.orderBy("loja_id")).collect()])
    assert found[0] == found[1] == found[2]
    kept = set(spark.sparkContext._jsc.getPersistentRDDs())
    line = ml.train_split("LinearRegression", data)
    assert line.getRegParam() == 0.0 and set(spark.sparkContext._jsc.getPersistentRDDs()) <= kept
    same = ml.train("LinearRegression", ml.training_layout(data).where("NOT is_test"))
    assert list(line.coefficients) == pytest.approx(list(same.coefficients))


def test_monthly_sums_and_customers_are_one_aggregate(spark):
    plan = monthly(sales_for_store(spark, 1, range(1, 5)), ["A"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("hashpartitioning") == 2


def test_a_table_of_levels_is_not_broadcast(spark):
    rows = spark.range(50).select("id", F.concat(F.lit("n"), F.col("id")).alias("c"))
    levels = rows.select(F.col("c").alias("nivel"), F.col("id").alias("posicao"))
    out = ml.dummies_by_table(rows, "c", levels, ["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert out.count() == 49
