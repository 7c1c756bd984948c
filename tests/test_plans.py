"""Plan-shape guards for the properties that matter at scale (checked on the smallest tables)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tillpoint.operators import features as feat
from tillpoint.operators.quality import audit
from tillpoint.operators.validate import clean_sales
from tillpoint.sources import testdata as td

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql())))
def test_no_cross_join(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(feat.ticket_medio(clean_sales(td.vendas(spark, SF))))
    scans = [line for line in p.splitlines() if "FileScan parquet" in line or "Scan parquet" in line]
    lineitem = [s for s in scans if "l_orderkey" in s][0]
    assert "l_returnflag" not in lineitem and "l_tax" not in lineitem and "l_discount" not in lineitem
    orders = [s for s in scans if "o_custkey" in s][0]
    assert "o_totalprice" not in orders and "o_orderpriority" not in orders  # F1 needs no channel


def test_top_k_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in plan(feat.top_produtos(clean_sales(td.vendas(spark, SF))))


def test_audit_is_one_main_aggregate(spark):
    a = audit(td.clientes_dq(spark, SF), td.REF_DATE)
    p = plan(a.report())
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
    assert "Subquery" in p  # the moments come in as a scalar subquery, not a join


def test_store_filter_reaches_the_scan(spark):
    from tillpoint.operators.reports import ultimos_meses_loja
    p = plan(ultimos_meses_loja(clean_sales(td.vendas(spark, SF)), 1))
    lineitem = [line for line in p.splitlines() if "l_suppkey" in line and "PushedFilters" in line]
    assert lineitem and "EqualTo(l_suppkey,1)" in lineitem[0]


def test_cleaning_filter_reaches_the_scan(spark, tmp_out):
    td.vendas(spark, SF).limit(5).write.parquet(f"{tmp_out}/v")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # the plan text cuts its filters short otherwise
    p = plan(clean_sales(spark.read.parquet(f"{tmp_out}/v")))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThan(quantidade,0)" in p and "GreaterThan(valor_total,0.00)" in p


def test_growth_and_weekday_are_one_aggregate(spark):
    v = clean_sales(td.vendas(spark, SF).select("data_venda", "loja_id", "quantidade", "valor_unitario", "valor_total"))
    for df in (feat.crescimento_mom(v), feat.sazonalidade_dia(v)):
        assert plan(df).split("Join")[0].count("HashAggregate") == 2  # partial and final


def test_split_ranks_one_bucket_only(spark):
    from tillpoint.operators import ml
    df = spark.range(1000).select(F.col("id").alias("loja_id"), F.lit("2024-05").alias("mes"))
    p = plan(ml.exact_split(df))
    whole = p.split("Union", 1)[1].split("\n   :- ", 1)[-1].split("\n   +- ", 1)[0]
    assert "Union" in p and "row_number" not in whole and "SortMergeJoin" not in p


def test_bytes_of_a_task_are_bounded_unless_set(spark):
    from tillpoint.session import apply_defaults
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    other = spark.newSession()
    other.conf.unset(key)
    apply_defaults(other)
    assert other.conf.get(key) == "16m"
    other.conf.set(key, "48m")
    apply_defaults(other)
    assert other.conf.get(key) == "48m"
