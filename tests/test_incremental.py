"""Feature tables kept by batches: equal to a full rebuild, whatever the batches; only touched months are read and replaced."""

import os
import re

import pytest
from pyspark.sql import functions as F

from fixtures import vendas_invalidas, vendas_teste
from tillpoint.operators import features as feat
from tillpoint.operators import incremental
from tillpoint.operators.incremental import FeatureStore
from tillpoint.operators.validate import clean_sales
from tillpoint.plans import jobs
from tillpoint.sources import testdata as td

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)


def assert_full(store, sales):
    full = feat.build_features(sales, td.REF_DATE)
    for name, want in full.items():
        assert rows(store.table(name)) == rows(want), name


def files(path):
    return {f: os.stat(f).st_mtime_ns for d, _, fs in os.walk(path) for f in (os.path.join(d, x) for x in fs) if f.endswith(".parquet")}


def test_batches_equal_a_full_rebuild(spark, tmp_out):
    sales = clean_sales(td.vendas(spark, SF)).cache()
    late = F.col("data_venda") > F.lit("1999-03-10").cast("date")
    mixed = F.pmod(F.xxhash64("produto_id", "cliente_id"), F.lit(3)) == 0
    store = FeatureStore(spark, f"{tmp_out}/s")
    store.apply(sales.where(late), td.REF_DATE)  # late sales first: earlier months come in afterwards
    assert_full(store, sales.where(late))
    store.apply(sales.where(~late & mixed), td.REF_DATE)
    store.apply(sales.where(~late & ~mixed), td.REF_DATE)
    assert_full(store, sales)
    sales.unpersist()


def test_only_touched_months_are_read_and_replaced(spark, tmp_out):
    sales = clean_sales(td.vendas(spark, SF)).withColumn("mes", feat.month_key())
    months = [r.mes for r in sales.select("mes").distinct().orderBy("mes").collect()]
    sales = sales.drop("mes")
    store = FeatureStore(spark, f"{tmp_out}/s")
    store.apply(sales, td.REF_DATE)
    before = files(f"{tmp_out}/s")
    more = sales.where(feat.month_key() == months[5]).withColumn("cliente_id", F.col("cliente_id") + 100_000)
    assert store.add(more) == [months[5]]
    for name in ("visitas", "categorias", "produtos"):
        plan = store.partial(name, [months[5]])._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^]]*mes#\d+ = " + months[5], plan)
    store.apply(more, td.REF_DATE)
    after = files(f"{tmp_out}/s")
    kept = {f for f in before if after.get(f) == before[f]}
    gone = {f.split(f"{tmp_out}/s/")[1] for f in before if f not in kept}
    for table in ("meses/diario_loja", "meses/cliente_mes", "meses/categorias", "tabelas/ticket_medio", "tabelas/top_produtos",
                  "tabelas/frequencia_cliente"):
        assert {f.split("mes=")[1].split("/")[0] for f in gone if f.startswith(table)} == {months[5]}, table
    assert min(f.split("mes=")[1].split("/")[0] for f in gone if f.startswith("tabelas/tendencia_7d")) == months[5]
    assert_full(store, sales.unionByName(more))


def test_a_batch_counts_once(spark, tmp_out):
    sales = clean_sales(vendas_teste(spark))
    store = FeatureStore(spark, f"{tmp_out}/s")
    for _ in range(2):
        assert store.apply(sales, td.REF_DATE) == ["2024-03", "2024-04"]
    assert_full(store, sales)
    assert store.apply(sales.where("false"), td.REF_DATE) == []
    # a run that was lost before its receipt is applied again over its own folders
    receipts = f"{tmp_out}/s/lotes"
    for d in os.listdir(receipts):
        os.rename(f"{receipts}/{d}/_SUCCESS", f"{receipts}/{d}/lost")
    assert store.apply(sales.orderBy(F.desc("produto_id")), td.REF_DATE) == ["2024-03", "2024-04"]
    assert_full(store, sales)
    # equal sales in a second batch are further sales: the batch differs by one row
    twice = sales.unionByName(sales.limit(1))
    store.apply(twice, td.REF_DATE)
    assert_full(store, sales.unionByName(twice))


def test_job_stops_on_an_invalid_batch(spark, tmp_out):
    good = jobs.run_features_batch(spark, vendas_teste(spark), f"{tmp_out}/s", td.REF_DATE)
    assert good.status == "done" and list(good.tables) == feat.FEATURE_NAMES and good.details["meses"] == ["2024-03", "2024-04"]
    before = files(f"{tmp_out}/s")
    bad = jobs.run_features_batch(spark, vendas_invalidas(spark), f"{tmp_out}/s", td.REF_DATE)
    assert bad.status == "validate_fail" and bad.errors and files(f"{tmp_out}/s") == before
    assert jobs.run_features_batch(spark, vendas_teste(spark).drop("custo"), f"{tmp_out}/s", td.REF_DATE).status == "validate_fail"
    with pytest.raises(ValueError):
        FeatureStore(spark, f"{tmp_out}/n").apply(
            clean_sales(vendas_teste(spark)).withColumn("data_venda", F.lit(None).cast("date")), td.REF_DATE)


def test_tables_of_a_step_are_written_at_once(spark, tmp_out, monkeypatch):
    import threading
    busy, most, lock, replace = 0, 0, threading.Lock(), FeatureStore._replace

    def watched(self, *args):
        nonlocal busy, most
        with lock:
            busy, most = busy + 1, max(most, busy + 1)
        try:
            replace(self, *args)
        finally:
            with lock:
                busy -= 1
    monkeypatch.setattr(FeatureStore, "_replace", watched)
    sales = clean_sales(vendas_teste(spark))
    store = FeatureStore(spark, f"{tmp_out}/s")
    store.apply(sales, td.REF_DATE)
    assert most >= 3
    assert_full(store, sales)


def odd_sales(spark):
    """Sales of 40 days in ten stores with unknown customers, stores, products and categories, and repeated rows."""
    i = F.col("id")
    rows = spark.range(600).select(
        F.expr("date_add(DATE'2024-01-20', CAST(id % 40 AS INT))").alias("data_venda"),
        F.when(i % 11 != 3, i * 7 % 10).alias("loja_id"), F.when(i % 13 != 5, i * 5 % 17).alias("produto_id"),
        F.when(i % 9 != 2, F.concat(F.lit("c"), (i % 3).cast("string"))).alias("categoria"), F.lit(2).cast("bigint").alias("quantidade"),
        F.lit(1.5).alias("valor_unitario"), ((i * 37 % 101) + F.lit(0.25)).cast("decimal(18,2)").alias("valor_total"),
        F.when(i % 10 != 4, F.lit(1.5)).cast("decimal(18,2)").alias("custo"), F.when(i % 4 != 1, i * 3 % 19).alias("cliente_id"))
    return rows.unionByName(rows.where("id % 6 = 0"))


def test_rows_are_shuffled_once_to_be_grouped_ranked_and_written(spark, tmp_out, monkeypatch):
    written, replace = [], FeatureStore._replace

    def watched(self, df, level, name, parts):
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        written.append((f"{level}/{name}".rstrip("/"), len(re.findall(r"Exchange \w+partitioning", plan))))
        replace(self, df, level, name, parts)
    monkeypatch.setattr(FeatureStore, "_replace", watched)
    monkeypatch.setattr(incremental, "TASK_ROWS", 50)
    sales, store = odd_sales(spark), FeatureStore(spark, f"{tmp_out}/s")
    store.apply(sales, td.REF_DATE)
    found = dict(written)
    assert {k: found[k] for k in ("parciais", "meses/diario_loja", "meses/cliente_mes", "tabelas/top_produtos")} == {
        "parciais": 1, "meses/diario_loja": 1, "meses/cliente_mes": 1, "tabelas/top_produtos": 1}
    assert found["tabelas/ticket_medio"] == found["tabelas/frequencia_cliente"] == 0
    assert_full(store, sales)


def test_many_tasks_and_unknown_keys_give_the_full_tables(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(incremental, "TASK_ROWS", 30)
    sales, store = odd_sales(spark), FeatureStore(spark, f"{tmp_out}/s")
    for part in ("data_venda < DATE'2024-02-10' AND cliente_id IS NULL", "data_venda >= DATE'2024-02-10'",
                 "data_venda < DATE'2024-02-10' AND cliente_id IS NOT NULL"):
        store.apply(sales.where(part), td.REF_DATE)
    assert_full(store, sales)
    # the months' sums of one batch are taken over, those of several are added
    assert rows(store.merged("categorias").select("mes", "loja_id", "categoria", "_r", "_c")) == rows(
        store.partial("categorias", ["2024-01", "2024-02"]).select("mes", "loja_id", "categoria", "_r", "_c"))


def test_a_store_of_an_earlier_layout_is_refused(spark, tmp_out):
    os.makedirs(f"{tmp_out}/s/parciais/visitas")
    with pytest.raises(ValueError):
        FeatureStore(spark, f"{tmp_out}/s").apply(odd_sales(spark), td.REF_DATE)
