"""Top products from summaries against plain sums; boosting in rounds against a plain version."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tillpoint.operators import boosting, heavy

SCHEMA = "g long, p long, w long"


def plain(rows, k):
    sums = defaultdict(Counter)
    for g, p, w in rows:
        sums[g][p] += w or 0
    out = set()
    for g, c in sums.items():
        first = sorted(c.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or 0))[:k]
        out |= {(g, p, w, i) for i, (p, w) in enumerate(first, 1)}
    return out


def found(spark, rows, k, parts=6, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return {(r.g, r.p, r._w, r.rank) for r in heavy.top_k(df, ["g"], "p", F.col("w"), k, **kw).collect()}


def skewed(seed, n=6000, products=900, groups=3):
    rnd = random.Random(seed)
    return [(min(groups - 1, int(rnd.expovariate(1.2))), int(products * rnd.random() ** 6), rnd.randint(1, 50)) for _ in range(n)]


@pytest.mark.parametrize("counters", [5, 40, 2000])
def test_same_as_plain_sums(spark, counters):
    rows = skewed(1)
    assert found(spark, rows, 5, counters=counters, budget=300) == plain(rows, 5)


def test_no_product_stands_out(spark):
    rows = [(1, i % 500, 7) for i in range(2000)] + [(2, i, 3) for i in range(400)]  # all tied
    assert found(spark, rows, 4, counters=8, budget=50) == plain(rows, 4)


def test_negative_null_and_large_values(spark):
    big = 2 ** 60
    rows = skewed(3) + [(0, 1, -4000), (1, 0, -9000), (None, None, 5), (None, big + 1, 5), (None, big + 3, None),
                        (big + 1, big + 5, 9), (big + 3, big + 5, 0), (big + 3, None, 0)]
    for counters in (3, 30, 3000):
        assert found(spark, rows, 3, counters=counters, budget=200) == plain(rows, 3)


def test_empty_and_too_few_counters(spark):
    assert found(spark, [], 3) == set()
    with pytest.raises(ValueError):
        found(spark, [], 3, counters=2)


def test_bound_holds_and_less_is_shuffled(spark):
    rows = skewed(5, n=30000, products=20000, groups=1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("_w", F.col("w"))
    parts = heavy.summaries(df, ["g"], "p", counters=64, budget=1000).collect()
    true, est = Counter(), Counter()
    for _, p, w in rows:
        true[p] += w
    for r in parts:
        if not r._grupo:
            est[r.p] += r._w
    error = sum(r._corte for r in parts if r._grupo)
    assert error > 0 and all(est[p] <= t <= est[p] + error for p, t in true.items())
    # a grouped sum sends one row per product and task
    grouped = df.withColumn("t", F.spark_partition_id()).select("t", "p").distinct().count()
    assert len([r for r in parts if not r._grupo]) <= 4 * 64 and grouped > 10 * 4 * 64


def test_long_run_hands_out_full_summaries(spark):
    rows = [(i % 400, i % 7, 1 + i % 5) for i in range(4000)]  # more groups than the budget holds
    assert found(spark, rows, 2, parts=1, counters=2, budget=100) == plain(rows, 2)


# -----------------------------------------------------------------------------------------------------------------------
def stump(xs, ys):
    """Depth-one regression tree: (threshold, left mean, right mean) of least squared error."""
    best = None
    values = sorted(set(xs))
    for a, b in zip(values, values[1:]):
        left = [y for x, y in zip(xs, ys) if x <= a]
        right = [y for x, y in zip(xs, ys) if x > a]
        ml_, mr = sum(left) / len(left), sum(right) / len(right)
        sse = sum((y - ml_) ** 2 for y in left) + sum((y - mr) ** 2 for y in right)
        if best is None or sse < best[0] - 1e-9:
            best = (sse, (a + b) / 2, ml_, mr)
    return best[1:]


def plain_rounds(train, val, rounds, step, tol):
    """Squared loss: the first tree fits the labels, later ones twice the residuals, each with weight ``step``."""
    def mse(rows, trees):
        return sum((y - sum(w * (a if x <= t else b) for w, (t, a, b) in trees)) ** 2 for x, y in rows) / len(rows)
    trees, errors, best, kept = [], [], None, 0
    for m in range(rounds):
        done = [sum(w * (a if x <= t else b) for w, (t, a, b) in trees) for x, _ in train]
        target = [y - d if m == 0 else 2 * (y - d) for (_, y), d in zip(train, done)]
        trees.append((1.0 if m == 0 else step, stump([x for x, _ in train], target)))
        now = mse(val, trees)
        errors.append((mse(train, trees), now))
        if m and best - now < tol * max(now, 0.01):
            break
        if best is None or now < best:
            best, kept = now, m + 1
    return errors[:kept]


def boost_frame(spark, train, val):
    rows = [(float(x), float(y), False) for x, y in train] + [(float(x), float(y), True) for x, y in val]
    df = spark.createDataFrame(rows, "x double, label double, is_val boolean")
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(df)


def boost_rows(seed):
    rnd = random.Random(seed)
    shape = {x: rnd.uniform(-20, 20) + x for x in range(20)}
    return ([(x, shape[x] + rnd.gauss(0, 6)) for x in range(20) for _ in range(3)],
            [(x, shape[x] + rnd.gauss(0, 6)) for x in range(20)])


@pytest.mark.parametrize("seed", [1, 2])
def test_rounds_same_as_plain(spark, seed):
    train, val = boost_rows(seed)
    data = boost_frame(spark, train, val).persist()
    model = boosting.fit_rounds(data, rounds=25, depth=1, step=0.3, tol=0.01)
    got = [(r.erro_treino, r.erro_validacao) for r in boosting.round_errors(model, data).orderBy("rodada").collect()]
    want = plain_rounds(train, val, 25, 0.3, 0.01)
    assert 1 < len(want) < 25 and len(got) == len(want)
    for g, w in zip(got, want):
        assert g == pytest.approx(w, rel=1e-9)


def test_boosting_edges(spark):
    train, _ = boost_rows(3)
    data = boost_frame(spark, train, [])
    model = boosting.fit_rounds(data.withColumn("is_val", F.lit(None).cast("boolean")), rounds=3, depth=2)
    rows = boosting.round_errors(model, data).collect()
    assert len(rows) == 3 and all(r.erro_validacao is None for r in rows)
    assert rows[0].erro_treino > rows[-1].erro_treino
    with pytest.raises(ValueError):
        boosting.fit_rounds(data.limit(0), rounds=3)


def test_hold_out_is_exact(spark):
    df = spark.range(50).select(F.col("id").alias("loja_id"), F.lit("2024-01").alias("mes"))
    assert boosting.hold_out(df).where("is_val").count() == 10


def test_small_batches_are_gathered(spark, monkeypatch):
    calls, added = [], heavy._added
    monkeypatch.setattr(heavy, "_added", lambda parts, by, sums: calls.append(len(parts)) or added(parts, by, sums))

    class Rows:  # the function that a task runs, in this process
        schema = spark.createDataFrame([], "g long, p long, _w long").schema

        def select(self, *columns):
            return self

        def mapInArrow(self, fn, schema):
            return fn

    batch = lambda i: heavy.pa.record_batch({"g": [1] * 100, "p": [*range(i * 100, i * 100 + 100)], "_w": [1] * 100})
    out = list(heavy.summaries(Rows(), ["g"], "p", counters=20_000, budget=50_000)(batch(i) for i in range(100)))
    assert sum(b.num_rows for b in out) == 10_000 and len(calls) <= 3
