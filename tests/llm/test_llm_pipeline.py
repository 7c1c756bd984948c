"""The corpus pipeline, stage by stage, against plain Python versions."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from test_llm_operators import brute_groups, check_packing
from tillpoint.llm import mixing
from tillpoint.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, SF), "test-stage")
        out.append((docs, after))
        docs = after
    return out


def test_registered():
    assert "pipeline" in E.queries()
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in E.queries() if q.startswith("op")) == list(range(1, 14))


def test_columns(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_quality_keeps_clean_documents(spark, stages):
    before, after = stages[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id for r in after.collect()}
    marked = {r.doc_id: r.quality for r in labels.collect()}
    here = {r.doc_id for r in before.collect()}
    good, bad = ([i for i in marked if i in here and marked[i] == q] for q in (1, 0))
    assert sum(i in kept for i in good) > 0.9 * len(good) and sum(i in kept for i in bad) < 0.4 * len(bad)


def test_line_dedup(stages):
    before, after = stages[1]
    rows = {r.doc_id: r.text for r in before.collect()}
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t in rows.items():
        for x in t.split("\n"):
            holders[key(x)].add(i)
    want = {i: "\n".join(x for x in t.split("\n") if len(key(x)) < 40 or len(holders[key(x)]) < 5
                         or max(holders[key(x)]) == i) for i, t in rows.items()}
    assert {r.doc_id: r.text for r in after.collect()} == want
    assert after.where("n_chars <> length(text)").isEmpty()


def test_jaccard(stages):
    before, after = stages[2]
    groups = brute_groups([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert Counter(r.doc_id for r in after.collect()) == Counter(i for i, _, c in groups if i == c)


def test_mixing_meets_budgets(spark, stages):
    before, after = stages[3]
    levels = corpus_pipeline.MIX_LEVELS
    count = lambda df: corpus_pipeline.with_domain(df).withColumn("n_tokens", mixing.count_tokens("text"))
    budgets = {tuple(r[c] for c in levels): r.budget for r in mixing.leaf_budgets(
        count(before), levels, corpus_pipeline.MIX_WEIGHTS, corpus_pipeline.MIX_SHARE, 1).collect()}
    took, spared = Counter(), defaultdict(list)
    kept = {r.doc_id for r in after.collect()}
    for r in count(before).collect():
        leaf = tuple(r[c] for c in levels)
        took[leaf] += r.n_tokens * (r.doc_id in kept)
        if r.doc_id not in kept:
            spared[leaf].append(r.n_tokens)
    longest = max(t for ts in spared.values() for t in ts)
    assert all(took[k] <= budgets[k] < took[k] + longest + 1 or not spared[k] for k in budgets)


def test_packing(spark, stages):
    before, after = stages[4]
    bins, least = check_packing(spark, after, [(r.doc_id, r.text) for r in before.collect()], 4096)
    assert bins <= least + 1
