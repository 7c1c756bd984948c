"""Line dedup across documents (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import BLANKS, ascii_lower, content_key, hash128, whole
from tillpoint.session import materialize


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                min_docs: int = 5) -> DataFrame:
    """Drop lines whose key occurs in at least ``min_docs`` documents, except in the largest id that holds it.

    A line's key is the line without ASCII white space at both ends, A-Z lower-cased; keys under ``min_chars`` code
    points never count. The input columns stay, with the kept lines (joined by a line feed) in ``text_col``; added are
    ``n_lines`` (before dropping) and ``n_dropped``.

    Only (id, content hash, position, key hash) rows are shuffled and counted; the count of distinct documents is a
    two-step aggregate, so a line that a third of all documents share is summed before it meets. The texts move once, to
    meet the positions to drop, and are cut there in time linear in their lines.

    Defined cases: null and empty texts are one empty line and come out empty; rows that share an id are one document
    for the count, yet each keeps its own text; null ids are one document, ranked lowest; repeated rows each come out;
    a text whose lines all go is empty; an empty table stays empty; columns named ``n_lines`` or ``n_dropped`` are
    replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    k1, k2 = content_key(text_col)
    keys = F.transform(F.split(ascii_lower(whole(text_col)), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)))
    long_keys = F.filter(F.transform(keys, lambda x, i: F.struct(i.alias("pos"), x.alias("key"))),
                         lambda s: F.length(s["key"]) >= min_chars)
    h1, h2 = hash128(F.col("l.key"))
    lines = materialize(
        docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), F.explode(long_keys).alias("l"))
        .select("id", "k1", "k2", F.col("l.pos").alias("pos"), h1.alias("h1"), h2.alias("h2")), "line-keys")
    # a struct counts and ranks null ids too
    # written, so that the join below deals both sides anew and a line held by very many documents can be split
    spread = materialize(
        lines.groupBy("h1", "h2")
        .agg(F.count_distinct(F.struct("id")).alias("n"), F.max(F.struct("id")).alias("last"))
        .where(F.col("n") >= min_docs)
        .select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), F.col("last.id").alias("last_id")), "common-lines")
    drops = (lines.join(spread, (lines["h1"] == spread["f1"]) & (lines["h2"] == spread["f2"]))
             .where(~F.col("id").eqNullSafe(F.col("last_id")))
             .groupBy(F.col("id").alias("__d_id"), F.col("k1").alias("__d1"), F.col("k2").alias("__d2"))
             .agg(F.sort_array(F.collect_set("pos")).alias("__drop")))
    rows = docs.withColumns({"__k1": k1, "__k2": k2})
    joined = rows.join(drops, rows[id_col].eqNullSafe(drops["__d_id"]) & (rows["__k1"] == drops["__d1"])
                       & (rows["__k2"] == drops["__d2"]), "left")
    joined = joined.withColumn("__lines", F.split(whole(text_col), "\n"))
    # the kept stretches between the positions to drop, put together again by position
    joined = joined.withColumn("__edges", F.concat(F.array(F.lit(-1)), F.col("__drop"), F.array(F.size("__lines"))))
    edges = F.col("__edges")
    stretches = F.transform(F.sequence(F.lit(1), F.size(edges) - 1), lambda i: F.slice(
        F.col("__lines"), F.get(edges, i - 1) + 2, F.get(edges, i) - F.get(edges, i - 1) - 1))
    kept = F.when(F.col("__drop").isNull(), whole(text_col)).otherwise(F.array_join(F.flatten(stretches), "\n"))
    out = {c: docs[c] for c in docs.columns} | {text_col: kept.alias(text_col)}
    return joined.select(*out.values(), F.size("__lines").cast("long").alias("n_lines"),
                         F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("n_dropped"))
