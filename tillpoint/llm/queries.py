"""The registered queries of this subpackage: thin, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.llm import (fingerprint, html_text, jaccard, lines, mixing, packing, quality, rtree, rules, shards,
                           spelling, urls, warc)
from tillpoint.llm.common import prepare, table

#: Rules of the URL filter; a few fixed rows.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
MIX_LEVELS = ["domain", "lang", "source"]
MIX_WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}}


def with_domain(docs: DataFrame) -> DataFrame:
    """The domain of a source: its number modulo 4; sources without a number share one domain."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), r"(\d{1,9})$", 1)
    return docs.withColumn("domain", F.concat(F.lit("d"), F.when(number == "", "x").otherwise(
        (F.when(number == "", "0").otherwise(number).cast("long") % 4).cast("string"))))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS t(host, path, verdict)")
    out = urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents").select("doc_id", "text"),
                            table(spark, sf_dir, "labels").select("doc_id", "quality"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"), measures=base)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("doc_id", *base, failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard.jaccard_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_shingles", "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_domain(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    out = mixing.mix(docs, MIX_LEVELS, MIX_WEIGHTS, total_share=0.6, max_epochs=2, seed=17)
    return out.select("doc_id", *MIX_LEVELS, "n_tokens", "epoch")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", "virtual_slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archive_and_read(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select(F.col("key").cast("long").alias("page_id"), "payload_bytes",
                      F.substring("digest", 6, 32).alias("payload_digest"), "record_type",
                      F.col("refers_to").cast("long").alias("refers_to"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(rtree.usable("embedding", "label"))
    moved = (F.col("label").cast("long") + 1) % 10
    rows = rows.select("vec_id", F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label").cast("long")).alias("label"),
                       rtree.quantised("embedding").alias("embedding"))
    return rtree.mine(rows, F.col("vec_id") % 100 == 0)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents").select("doc_id", "text"), drop_every=31)


def _query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    return run


QUERIES = {f.__name__: _query(f) for f in (
    op1_url_filters, op2_quality_classifier, op3_quality_rules, op4_html_extraction, op5_ngram_jaccard,
    op6_line_dedup, op7_packing,
    op8_mixing, op9_fingerprints, op10_sharding, op11_warc, op12_hard_negatives, op13_spelling_variants)}
