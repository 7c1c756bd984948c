"""Hard negatives: the R-tree's parts, and whole results against a plain version."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillpoint.llm import rtree
from tillpoint.llm.common import prepare

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, is_anchor, positives=5, negatives=10):
    """rows: (id, whole-number vector, label), each a row of its own."""
    out = []
    order = lambda a: lambda j: (-dot(rows[a][1], rows[j][1]), rows[j][0] is None, rows[j][0] or 0)
    dot = lambda x, y: sum(int(p) * int(q) for p, q in zip(x, y))
    for a, (i, x, lab) in enumerate(rows):
        if i is None or not is_anchor(i):
            continue
        near = sorted((j for j in range(len(rows)) if j != a and len(rows[j][1]) == len(x)), key=order(a))
        for p in [j for j in near if rows[j][2] == lab][:positives]:
            ps = dot(x, rows[p][1])
            fits = [j for j in near if rows[j][2] != lab and 30 * ps <= 100 * dot(x, rows[j][1]) <= 90 * ps][:negatives]
            out += [(i, rows[p][0], k, rows[j][0], ps, dot(x, rows[j][1])) for k, j in enumerate(fits, 1)]
    return Counter(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(i, [int(v) for v in x], lab) for i, x, lab in rows], "vec_id long, embedding array<long>, label long")
    return Counter(tuple(r) for r in rtree.mine(df, F.col("vec_id") % 10 == 0, **kw).collect())


@pytest.fixture
def small_tree(monkeypatch):
    for name, value in (("LEAF", 4), ("FAN", 3), ("TILE", 40), ("BLOCK", 7), ("HELD", 2), ("GROUPS", 5)):
        monkeypatch.setattr(rtree, name, value)


def test_packing_keeps_every_row(small_tree):
    rng = np.random.default_rng(1)
    for n, d in ((1, 3), (4, 1), (57, 2), (300, 6), (50, 0)):
        x = rng.integers(-9, 9, (n, d))
        pages = list(rtree._pages(rtree._tiles(x, 4)))
        assert sorted(np.concatenate(pages).tolist()) == list(range(n))
        if d:
            assert max(map(len, pages)) <= 4 or len(np.unique(x, axis=0)) < n
            x = x[np.concatenate(pages)]
            levels = rtree._boxes(x)
            assert len(levels[-1][0]) == 1 and (levels[-1][0][0] == x.min(axis=0)).all()
            assert all((lo <= x[i // 1]).all() for i in range(n) for lo in [levels[0][0][i // 4]])


def test_regions_send_equal_vectors_to_one_place():
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 50, (1000, 8))
    regions = rtree.Regions(x[:300], 16)
    got = regions.of(x)
    assert 8 <= regions.count <= 40 and set(got) <= set(range(regions.count))
    assert (regions.of(x[::-1]) == got[::-1]).all()
    tight = [x[got == r] for r in set(got)]
    assert sum(len(t) * t.var(axis=0).sum() for t in tight) < 1000 * x.var(axis=0).sum() * 0.9


def test_against_plain_version(spark, small_tree):
    prepare(spark)
    rng = random.Random(3)
    centres = [[rng.randint(-40, 40) for _ in range(5)] for _ in range(6)]
    rows = []
    for i in range(400):
        c = rng.choice(centres)
        rows.append((i, [v + rng.randint(-6, 6) for v in c], rng.randint(0, 2)))
    rows += [(rng.randint(0, 60), [1, 2, 3, 4, 5], rng.randint(0, 2)) for _ in range(150)]  # equal vectors and ids
    rows += [rows[10], rows[10], (None, [40, 40, 40, 40, 40], 1), (None, [40, 40, 40, 40, 40], 0)]
    rows += [(1000, [0] * 5, 0), (1010, [1 << 26] * 5, 1), (1011, [1 << 26] * 5, 1), (1012, [1 << 25] * 5, 0)]
    rows += [(2000, [3, 4], 0), (2001, [6, 8], 0), (2002, [3, 1], 1), (3000, [], 0), (3001, [], 0), (3002, [], 1), (4000, [7], 5)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows, positives=2, negatives=3) == brute(rows, lambda i: i % 10 == 0, 2, 3)


def test_pruning_skips_boxes(small_tree):
    """Of clustered vectors, few leaves are scored; the best rows are those of a full scan."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(-5, 5, (100, 6)) + 100 * c for c in rng.integers(-1, 2, (8, 6))]).astype(np.int64)
    order = np.concatenate(list(rtree._pages(rtree._tiles(x, 4))))
    x = x[order]
    levels = rtree._boxes(x)
    kind, data = rtree._packed(x)
    lows, highs = (np.concatenate([level[k] for level in levels]) for k in (0, 1))
    n = len(x)
    tile = rtree.Tile({"n": n, "dim": 6, "kind": kind, "x": data, "n_boxes": len(lows),
                       "lows": lows.astype(rtree._KINDS[kind]).tobytes(), "highs": highs.astype(rtree._KINDS[kind]).tobytes(),
                       "rows": np.arange(n, dtype="<i8").tobytes(), "ids": np.arange(n, dtype="<i8").tobytes(),
                       "labels": np.zeros(n, "<i8").tobytes(), "no_ids": np.zeros(n, bool).tobytes()})
    offered = []
    for _ in range(3):
        q = rtree.Queries(*(np.array([v]) for v in (1, -1, 0, -(1 << 62), 1 << 62)), x[7:8], np.full((1, 5), rtree.NONE),
                          np.zeros((1, 5), int), np.zeros((1, 5), int), np.zeros((1, 5), bool))
        plain = q.offer
        q.offer = lambda *a, plain=plain: (offered.append(1), plain(*a))
        tile.search(q, True)
    score = x @ x[7]
    assert q.row[0].tolist() == np.lexsort((np.arange(n), -score))[:5].tolist()
    assert len(offered) < 3 * len(levels[0][0]) / 4


def test_rows_that_take_no_part(spark):
    prepare(spark)
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.5], 0), (1, [0.9, 0.5], 0), (2, [0.5, 0.1], 1), (3, None, 0), (4, [1.0, None], 0), (5, [nan, 1.0], 1),
            (6, [inf, 1.0], 1), (7, [1.0, 1.0], None), (8, [-inf, 1.0], 0), (None, [0.6, 0.1], 1)]
    df = spark.createDataFrame(rows, KIND).withColumns({c: F.lit(3) for c in ("row", "region", "dim", "q", "x", "n", "id")})
    good = df.where(rtree.usable("embedding", "label"))
    assert Counter(r.vec_id for r in good.collect()) == Counter([0, 1, 2, None])
    whole = good.withColumn("embedding", rtree.quantised("embedding"))
    assert next(r.embedding for r in whole.collect() if r.vec_id == 2) == [128, 25]
    got = Counter(tuple(r) for r in rtree.mine(whole, F.col("vec_id") % 100 == 0).collect())
    assert got == Counter([(0, 1, 1, None, 75264, 42368), (0, 1, 2, 2, 75264, 35968)])
    assert rtree.mine(whole.where("false"), F.col("vec_id") % 100 == 0).count() == 0
    assert rtree.mine(whole, F.lit(False)).count() == 0
