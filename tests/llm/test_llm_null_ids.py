"""Null ids beside ids that a double cannot hold, and pipeline stages over tables with odd rows and columns."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from tillpoint.llm import fingerprint, jaccard, packing, quality, queries, rules, shards
from tillpoint.llm.common import prepare

SF = "/root/testdata/sf0.001"
BIG = [(1 << 60) + k for k in (1, 3, 5)]
TEXTS = [" ".join(f"{k}{i}" for i in range(80)) for k in ("ax", "by", "cz", "dw")]
ROWS = list(zip([None, *BIG], TEXTS))
IDS = Counter([None, *BIG])


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame(ROWS, "doc_id long, text string").coalesce(1)


def ids(df):
    return Counter(r.doc_id for r in df.collect())


def test_ids_stay_exact(spark, docs):
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(BIG)], "doc_id long, quality int")
    assert ids(quality.classify(docs, labels)) == IDS
    kept = rules.apply_rules(docs.withColumn("other", F.when(F.col("doc_id").isNotNull(), F.col("doc_id") + 1)), rules=[])
    assert ids(kept) == IDS and {r.other for r in kept.collect()} == {None, *(i + 1 for i in BIG)}
    groups = jaccard.jaccard_groups(docs).collect()
    assert Counter((r.doc_id, r.component_id) for r in groups) == Counter((i, i) for i in IDS)
    copies = docs.unionByName(spark.createDataFrame([(BIG[2] + 2, TEXTS[3]), (BIG[0], TEXTS[1])], docs.schema)).coalesce(1)
    assert Counter((r.doc_id, r.component_id) for r in jaccard.jaccard_groups(copies).collect()) == Counter(
        [(None, None), *((i, i) for i in BIG), (BIG[2] + 2, BIG[2]), (BIG[0], BIG[0])])
    for table in (docs, copies):
        assert ids(jaccard.drop_copies(table)) == IDS
    assert Counter(r.doc_id for r in packing.pack(docs).collect()) == IDS
    out = {r.doc_id: r for r in fingerprint.fingerprints(docs, partitions=1).collect()}
    assert Counter(out.keys()) == IDS
    assert ids(shards.shard_documents(docs, shards=2)) == IDS


def odd_documents(spark):
    """Documents of the test table with nulls, empty and very long texts, repeated rows, null ids and clashing columns."""
    base = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(None, TEXTS[0], "en", "src1", 5), (BIG[0], None, None, None, None), (BIG[1], "", "de", "src2", 0),
            (BIG[2], "word " * 50_000, "fr", "src3", None), (BIG[2], "word " * 50_000, "fr", "src3", None), (None, None, None, None, None)]
    extra = spark.createDataFrame(rows, T.StructType([T.StructField(f.name, f.dataType) for f in base.schema.fields]))
    names = ("l_id", "id", "t", "node", "comp", "uid", "domain", "s_id", "h", "pos", "epoch", "budget", "supply", "key", "score",
             "kept", "stats", "y", "n_tokens", "k", "size", "run", "leaf", "part", "line", "n")
    return base.unionByName(extra).withColumns({c: F.lit(7) for c in names})


def test_stages_take_odd_tables(spark):
    prepare(spark)
    docs = odd_documents(spark).cache()
    kinds, every = docs.dtypes, Counter(map(tuple, docs.collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).dtypes == kinds, name
        assert stage(spark, docs.where("false"), SF).count() == 0, name
    dedup = corpus_pipeline.line_dedup(spark, docs, SF)
    assert ids(dedup) == ids(docs) and dedup.where("n_chars <> length(coalesce(text, ''))").isEmpty()
    good = corpus_pipeline.quality_classifier(spark, docs, SF)
    assert not Counter(map(tuple, good.collect())) - every
    alone = corpus_pipeline.ngram_jaccard_join(spark, docs, SF)
    assert not Counter(map(tuple, alone.collect())) - every
    left = Counter((r.doc_id, r.text) for r in alone.collect())
    assert left[None, TEXTS[0]] == 1 and left[None, None] == 1 and left[BIG[0], None] == 1 and left[BIG[1], ""] == 1
    assert left[BIG[2], "word " * 50_000] == 1
    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    assert not Counter(map(tuple, mixed.collect())) - every and mixed.count() < docs.count()
    pieces = corpus_pipeline.best_fit_packing(spark, docs, SF)
    assert set(ids(pieces)) == set(ids(docs))
    assert corpus_pipeline.best_fit_packing(spark, docs.where("false"), SF).count() == 0
    docs.unpersist()


def test_domain_of_a_source(spark):
    rows = [("src6",), ("src",), (None,), ("x12345678901",), ("4",)]
    out = queries.with_domain(spark.createDataFrame(rows, "source string").withColumn("domain", F.lit(1)))
    assert [r.domain for r in out.collect()] == ["d2", "dx", "dx", f"d{345678901 % 4}", "d0"]


def test_held_out_rows_are_never_learned_from(spark, docs):
    """A label of a held-out row changes no score."""
    rows = [(i, "good plain text with some words. " * (5 + i % 7) if i % 2 else "!!! $$$ @@ " * (3 + i % 5)) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(i, i % 2) for i in range(200)]
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    score = lambda ls: {r.doc_id: r.score for r in quality.classify(
        table, spark.createDataFrame(ls, "doc_id long, quality int")).collect()}
    one, other = score(labels), score([(i, 1 - y if i in held else y) for i, y in labels])
    assert held and one.keys() == other.keys() and all(abs(one[i] - other[i]) < 1e-9 for i in one)
