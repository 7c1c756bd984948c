"""Co-partitioned tables are joined without an exchange, with the rows of a plain join."""

import uuid

import pytest
from pyspark.sql import functions as F

from tillpoint.plans import catalog
from tillpoint.sources import buckets as bk
from tillpoint.sources.tables import table

SF = "/root/testdata/sf0.001"


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def name():
    return f"t_{uuid.uuid4().hex[:10]}"


def test_join_has_no_exchange(spark, tmp_out):
    li, od = name(), name()
    lines, orders = table(spark, SF, "lineitem"), table(spark, SF, "orders")
    bk.write_bucketed(lines, li, f"{tmp_out}/l", ["l_orderkey"], 8)
    bk.write_bucketed(orders, od, f"{tmp_out}/o", ["o_orderkey"], 8)
    assert bk.bucket_spec(spark, li) == bk.BucketSpec(8, ("l_orderkey",)) and bk.bucket_spec(spark, od).keys == ("o_orderkey",)
    columns = {li: ["l_quantity"], od: ["o_custkey"]}
    joined = bk.join_bucketed(spark, li, od, columns)
    p = plan(joined)
    assert "SortMergeJoin" in p and "Exchange" not in p and "l_tax" not in p
    per_order = joined.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"))  # the buckets serve the grouping, too
    assert "Exchange" not in plan(per_order)
    want = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select("l_orderkey", "l_quantity", "o_orderkey", "o_custkey")
    assert sorted(joined.select(*want.columns).collect()) == sorted(want.collect())
    with pytest.raises(ValueError):
        bk.write_bucketed(orders, other := name(), f"{tmp_out}/x", ["o_orderkey"], 4)
        bk.join_bucketed(spark, li, other, {li: [], other: []})
    spark.createDataFrame([(1,)], "k long").write.option("path", f"{tmp_out}/p").saveAsTable(flat := name())
    with pytest.raises(ValueError):
        bk.join_bucketed(spark, li, flat, {li: [], flat: []})


def test_nulls_appends_and_two_keys(spark, tmp_out):
    a, b = name(), name()
    left = [(1, "x", 10), (1, "y", 11), (None, "x", 12), (2, None, 13), (3, "z", 14), (3, "z", 15)]
    right = [(1, "x", "A"), (3, "z", "B"), (None, "x", "C"), (2, None, "D")]
    for part, mode in ((left[:3], "overwrite"), (left[3:], "append")):
        bk.write_bucketed(spark.createDataFrame(part, "k long, s string, v long"), a, f"{tmp_out}/a", ["k", "s"], 4, mode)
    bk.write_bucketed(spark.createDataFrame(right, "k2 long, s2 string, w string"), b, f"{tmp_out}/b", ["k2", "s2"], 4)
    out = bk.join_bucketed(spark, a, b, {a: ["v"], b: ["w"]}, "left")
    assert "Exchange" not in plan(out)
    assert sorted((r.v, r.w) for r in out.collect()) == [(10, "A"), (11, None), (12, None), (13, None), (14, "B"), (15, "B")]


def test_bucket_count():
    assert bk.buckets_for(0, 100) == 8 and bk.buckets_for(10**9, 100) == 512
    assert 10**9 * 100 / bk.buckets_for(10**9, 100) <= bk.BUCKET_BYTES


def test_registered_query_has_no_exchange_below_its_join(spark):
    p = plan(catalog.QUERIES["vendas_copart_canal"](spark, SF))
    join = p[p.index("SortMergeJoin"):].split("== Initial Plan ==")[0]
    assert "Exchange" not in join and "Scan parquet" in join
