"""Corpus pipeline: quality classifier, line dedup, n-gram Jaccard join, mixing to target weights, best-fit packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tillpoint.llm import jaccard, lines, mixing, packing, quality  # noqa: E402
from tillpoint.llm.common import prepare, table  # noqa: E402
from tillpoint.llm.queries import MIX_LEVELS, MIX_WEIGHTS, with_domain  # noqa: E402
from tillpoint.session import apply_defaults, materialize  # noqa: E402

#: Share of the tokens that reach the mixing stage which the mix may hold.
MIX_SHARE = 0.8


def _documents(out: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, with ``n_chars`` following the text."""
    if "n_chars" in out.columns:
        kind = like.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))
    return out.select(*like.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of the documents at hand."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many of them share."""
    return _documents(lines.dedup_lines(docs), docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word n-grams, a similarity of 0.8 or more."""
    prepare(spark)
    return jaccard.drop_copies(docs, n=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet the weights of domains, languages and sources, each once."""
    mixed = mixing.mix(with_domain(docs), MIX_LEVELS, MIX_WEIGHTS, total_share=MIX_SHARE, max_epochs=1, seed=17)
    return mixing.chosen_documents(docs, mixed)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [("quality classifier", quality_classifier), ("line dedup", line_dedup),
          ("n-gram Jaccard join", ngram_jaccard_join), ("mixing sources to target weights", mix_sources),
          ("best-fit packing", best_fit_packing)]

#: SQL can express neither the classifier, the join at scale nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's result is written in the shared folder."""
    apply_defaults(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
