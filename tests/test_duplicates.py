"""The two-pass filter counts duplicates exactly, and shuffles far less than the key values."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillpoint.operators import duplicates as dup
from tillpoint.operators.quality import audit
from tillpoint.sources import testdata as td

SF = "/root/testdata/sf0.001"


def found(df, key="k", **kw):
    return {r[key]: r.n for r in dup.duplicate_keys(df, key, **kw).collect()}


def count(df, key="k"):
    r, = dup.count_duplicates(df, key).collect()
    assert r.coluna == key
    return r.duplicatas


def test_against_plain_counts(spark):
    rng = random.Random(1)
    values = [rng.choice(["a", "b", *map(str, range(3000))]) for _ in range(4000)] + ["hot"] * 2000 + [None] * 40
    df = spark.createDataFrame([(v,) for v in values], "k string").repartition(7)
    want = {v: n for v, n in Counter(values).items() if n > 1 and v is not None}
    for chunks in (None, 1, 50):
        assert found(df, chunks=chunks) == want
    nulls = values.count(None)
    assert count(df) == len(values) - len(set(values)) and nulls > 1
    assert count(df.where("k IS NULL").limit(1)) == 0 and count(df.where("false")) == 0


def test_equal_floats_and_odd_names(spark):
    rows = [(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (float("nan"),), (1.5,), (None,)]
    df = spark.createDataFrame(rows, "`a.b` double")
    assert count(df, "a.b") == 3
    df = spark.range(50).select((F.col("id") % 20).cast("decimal(30,2)").alias("chunk"), F.lit(1).alias("offset"))
    assert count(df, "chunk") == 30 and count(df, "offset") == 49


def test_shared_positions_add_candidates_only(spark, monkeypatch):
    """Keys on a bit string that is far too short: every position is seen twice, counts stay exact."""
    monkeypatch.setattr(dup.F, "xxhash64", lambda c: F.pmod(F.crc32(F.col(c).cast("string")), F.lit(64)).cast("long"))
    values = [str(i % 700) for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "k string").repartition(5)
    assert found(df) == {v: 2 for v, n in Counter(values).items() if n > 1}


def test_lists_of_a_task(monkeypatch):
    chunk, offset = np.array([3, 1, 3, 3, 1, 3, 3]), np.array([7, 5, 7, 7, 9, 2, 7])
    assert [(c, o.tolist()) for c, o in dup._by_chunk(chunk, offset)] == [(1, [5, 9]), (3, [2, 7, 7])]
    assert list(dup._by_chunk(np.zeros(0, int), np.zeros(0, int))) == []


def test_same_counts_as_the_audit(spark):
    df = td.clientes_dq(spark, SF)
    want = {r.coluna: r.duplicatas for r in audit(df, td.REF_DATE, key_columns=("cpf", "email_alt", "estado")).unicidade_table().collect()}
    assert {k: count(df, k) for k in want} == want and want["estado"] > 0


@pytest.mark.parametrize("partitions", [4, 12])
def test_shuffle_is_smaller_than_the_keys(spark, partitions):
    """Bytes that the filter's exchange moves against those of the key values."""
    df = spark.range(200_000).select(F.concat(F.lit("CPF-0000-"), F.col("id")).alias("k")).repartition(partitions).cache()
    df.count()

    def moved(out):
        out.collect()
        plan, total, todo = out._jdf.queryExecution().executedPlan(), 0, []
        todo.append(plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)
        while todo:
            node = todo.pop()
            if node.nodeName() == "Exchange":
                total += node.metrics().apply("shuffleBytesWritten").value()
            if "QueryStage" in node.nodeName():
                todo.append(node.plan())
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
        return total

    exact = moved(df.agg(F.count_distinct("k")))
    filtered = moved(dup.duplicate_keys(df, "k", chunks=4))
    assert 0 < filtered < exact / 1.5, (filtered, exact)
    print(f"shuffled bytes: {filtered} by the filter, {exact} by the distinct count")
    df.unpersist()
