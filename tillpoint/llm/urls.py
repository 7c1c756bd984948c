"""URL filters: host-suffix and path-prefix expressions looked up by short hash prefixes (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import ascii_lower

#: Hex digits of the digest that the equi-join runs on; the full digest is confirmed afterwards.
SHORT_HEX = 8


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty for null and for a string without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Judge every row's URL by the longest fitting rule; adds ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has (host, path, verdict). A rule fits its host and all subdomains when the URL's path starts with the
    rule's. Every URL is expanded into host suffixes x path prefixes (prefix lengths that some rule has), the
    expressions meet the rules on the first hex digits of their digest, and the whole digest is confirmed. Each
    distinct (host, path) is looked up once, so a hot URL costs one lookup.

    Defined cases: a null URL or one without ``://`` has an empty host and path and gets ``default``; rules with a
    null field are ignored; of equally long rules the longer host wins, then ``block``; repeated rows are each judged;
    without rules all get ``default``; input columns named like an added one are replaced, all others stay.
    """
    host, path = split_url(F.col(url))
    rows = (pages.withColumns({"__host": host, "__path": path})
            .drop("host", "path", "rule", "verdict"))
    rules = (rules.select(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"),
                          F.col("verdict").alias("r_verdict")).dropna())
    # one integer per distinct length of a rule's path, not per rule
    lengths = [r[0] for r in rules.select(F.length("r_path")).distinct().collect()]
    rules = (rules.withColumn("r_rule", F.concat("r_host", "r_path"))
             .withColumn("r_digest", _digest(F.col("r_rule")))
             .withColumn("r_short", F.substring("r_digest", 1, SHORT_HEX)))

    parts = F.split("__host", "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)),
                           lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    wanted = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"),
                      lambda n: n <= F.length("__path"))
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(
        wanted, lambda n: F.struct(s.alias("s"), F.concat(s, F.substr(F.col("__path"), F.lit(1), n)).alias("e")))))
    asked = (rows.select("__host", "__path").where(F.col("__host") != "").distinct()
             .select("__host", "__path", F.explode(expressions).alias("x"))
             .select("__host", "__path", F.col("x.s").alias("suffix"), _digest(F.col("x.e")).alias("digest"))
             .withColumn("short", F.substring("digest", 1, SHORT_HEX)))
    fits = (asked.join(rules, asked["short"] == rules["r_short"])
            .where((F.col("digest") == F.col("r_digest")) & (F.col("suffix") == F.col("r_host"))))
    rank = F.struct(F.length("r_rule"), F.length("r_host"), (F.col("r_verdict") == "block").cast("int"),
                    F.col("r_rule"), F.col("r_verdict"))
    best = (fits.groupBy("__host", "__path").agg(F.max(rank).alias("b"))
            .select(F.col("__host").alias("b_host"), F.col("__path").alias("b_path"),
                    F.col("b.r_rule").alias("rule"), F.col("b.r_verdict").alias("verdict")))
    out = rows.join(best, (rows["__host"] == best["b_host"]) & (rows["__path"] == best["b_path"]), "left")
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return out.select(*[rows[c] for c in keep], F.col("__host").alias("host"), F.col("__path").alias("path"), "rule",
                      F.coalesce("verdict", F.lit(default)).alias("verdict"))
