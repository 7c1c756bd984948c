"""Mixing sources to target weights by hierarchical budgets (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import WORD, content_key, whole

#: Hex digits of the order key that name its bucket; a leaf is summed per bucket, then ordered inside the buckets.
BUCKET_HEX = 3


def count_tokens(text: str) -> Column:
    """Budget unit: words of the whole text."""
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def _weight(level: str, weights: dict[str, int]) -> Column:
    w = F.lit(1).cast("long")
    for value, n in weights.items():
        w = F.when(F.col(level) == value, F.lit(n).cast("long")).otherwise(w)
    return w


def _same(a: DataFrame, b: DataFrame, cols: list[str]):
    cond = F.lit(True)
    for c in cols:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def leaf_budgets(units: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], total_share: float,
                 max_epochs: int) -> DataFrame:
    """(levels..., supply, budget) of every leaf of the tree.

    A node can take at most its subtree's supply times ``max_epochs``. From the root down, a node's budget is divided
    among its children by weight; children that cannot take their part get what they have and the others share the rest
    by weight (the level where that stops is found in one pass over the children, ordered by supply per weight). A
    shortage so goes to siblings first; only what a whole subtree lacks goes to the siblings of its ancestor.
    """
    leaves = units.groupBy(*levels).agg(F.sum("n_tokens").alias("supply"))
    usable = F.col("supply") * max_epochs
    for level in levels:  # a weight of 0 shuts the subtree
        usable = F.when(_weight(level, weights.get(level, {})) > 0, usable).otherwise(F.lit(0).cast("long"))
    leaves = leaves.withColumn("cap", usable)
    budgets = None
    for depth in range(1, len(levels) + 1):
        path, parent = levels[:depth], levels[:depth - 1]
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap"), F.sum("supply").alias("supply"))
        w = F.greatest(_weight(path[-1], weights.get(path[-1], {})), F.lit(1).cast("long"))
        nodes = nodes.withColumn("w", w)
        if budgets is None:
            every = Window.partitionBy()
            room = F.least(F.floor(F.sum("supply").over(every) * F.lit(float(total_share))).cast("long"),
                           F.sum("cap").over(every))
            nodes = nodes.withColumn("room", room)
        else:
            up = budgets.select(*[F.col(c).alias(f"up_{c}") for c in parent], F.col("budget").alias("room"))
            cond = F.lit(True)
            for c in parent:
                cond = cond & F.col(c).eqNullSafe(F.col(f"up_{c}"))
            nodes = nodes.join(up, cond).select(*path, "cap", "supply", "w", "room")
        siblings = Window.partitionBy(*parent)
        inorder = siblings.orderBy(F.col("cap") / F.col("w"), F.col(path[-1]))
        nodes = (nodes
                 .withColumn("before", F.coalesce(F.sum("cap").over(inorder.rowsBetween(
                     Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
                 .withColumn("w_left", F.sum("w").over(inorder.rowsBetween(0, Window.unboundedFollowing)))
                 .withColumn("short", F.col("cap") * F.col("w_left") <= F.col("w") * (F.col("room") - F.col("before")))
                 .withColumn("rest", F.col("room") - F.sum(F.when(F.col("short"), F.col("cap")).otherwise(
                     F.lit(0).cast("long"))).over(siblings))
                 .withColumn("w_rest", F.sum(F.when(F.col("short"), F.lit(0).cast("long")).otherwise(F.col("w")))
                             .over(siblings))
                 .withColumn("budget", F.when(F.col("short"), F.col("cap")).otherwise(
                     F.expr("(w * rest) div greatest(w_rest, 1L)"))))
        budgets = nodes.select(*path, "supply", "budget")
    return budgets


def mix(docs: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], total_share: float, max_epochs: int = 1,
        seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Choose documents so that the leaves of the tree ``levels`` meet their budgets.

    One row per chosen document and epoch: ``id_col``, the content key ``k1, k2``, ``levels``, ``n_tokens``, ``epoch``.
    ``weights`` gives integer weights per level and value (1 where none is given, 0 shuts a node); the whole budget is
    ``total_share`` of all tokens. Every epoch has its own seeded order. A leaf takes whole epochs while its
    budget lasts, then from the next epoch's order the longest prefix whose tokens stay within the rest.

    The prefix is found without ordering a leaf in one place: tokens are summed per leaf and bucket (the first hex
    digits of the order key), the bucket sums are accumulated, and only rows of one bucket are ordered together.

    Defined cases: a null text has no tokens; null level values are a node of their own with weight 1; rows equal in id,
    text and levels are one document with the tokens of all; null ids are allowed; a leaf without tokens or budget gives
    nothing; an empty table gives nothing; further columns are ignored.
    """
    k1, k2 = content_key(text_col)
    units = (docs.select(F.col(id_col).alias(id_col), k1.alias("k1"), k2.alias("k2"), *levels,
                         count_tokens(text_col).alias("n_tokens"))
             .groupBy(id_col, "k1", "k2", *levels).agg(F.sum("n_tokens").alias("n_tokens")))
    leaves = leaf_budgets(units, levels, weights, total_share, max_epochs)
    leaves = (leaves.where((F.col("supply") > 0) & (F.col("budget") > 0))
              .withColumn("full", F.expr("budget div supply")).withColumn("rest", F.expr("budget % supply"))
              .select(*[F.col(c).alias(f"leaf_{c}") for c in levels], "full", "rest"))
    cond = F.lit(True)
    for c in levels:
        cond = cond & F.col(c).eqNullSafe(F.col(f"leaf_{c}"))
    order = F.md5(F.concat_ws("|", F.lit(seed), F.col("full") + 1, F.col(id_col)))
    rows = (units.join(leaves, cond).withColumn("ord", order)
            .withColumn("bucket", F.substring("ord", 1, BUCKET_HEX))
            .select(id_col, "k1", "k2", *levels, "n_tokens", "full", "rest", "ord", "bucket"))
    leaf_order = Window.partitionBy(*levels).orderBy("bucket")
    sums = (rows.groupBy(*levels, "bucket").agg(F.sum("n_tokens").alias("n"))
            .withColumn("start", F.sum("n").over(leaf_order) - F.col("n"))
            .select(*[F.col(c).alias(f"sum_{c}") for c in levels], F.col("bucket").alias("sum_bucket"), "start"))
    cond = F.col("bucket") == F.col("sum_bucket")
    for c in levels:
        cond = cond & F.col(c).eqNullSafe(F.col(f"sum_{c}"))
    inside = (Window.partitionBy(*levels, "bucket").orderBy("ord", id_col, "k1", "k2")
              .rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("run", F.sum("n_tokens").over(inside)).join(sums, cond)
    last = F.when((F.col("rest") > 0) & (F.col("start") + F.col("run") <= F.col("rest")), 1).otherwise(0)
    rows = rows.withColumn("epochs", (F.col("full") + last).cast("int")).where(F.col("epochs") > 0)
    return rows.select(id_col, "k1", "k2", *levels, "n_tokens",
                       F.explode(F.sequence(F.lit(1), F.col("epochs"))).alias("epoch"))


def chosen_documents(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``mix`` chose, once per epoch, with their own columns only."""
    k1, k2 = content_key(text_col)
    picked = mixed.groupBy(F.col(id_col).alias("p_id"), F.col("k1").alias("p1"), F.col("k2").alias("p2")).agg(
        F.max("epoch").alias("p_epochs"))
    rows = docs.withColumns({"__k1": k1, "__k2": k2})
    joined = rows.join(picked, rows[id_col].eqNullSafe(picked["p_id"]) & (rows["__k1"] == picked["p1"])
                       & (rows["__k2"] == picked["p2"]))
    return (joined.withColumn("__epoch", F.explode(F.sequence(F.lit(1), picked["p_epochs"])))
            .select(*[rows[c] for c in docs.columns]))
