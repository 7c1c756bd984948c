"""Sharding by fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import content_key, whole
from tillpoint.session import checkpoint_dir, materialize

#: Fixed number of virtual slots; the map holds one row for each, whatever the size of the table.
SLOTS = 4096
#: Hash buckets of a shard, also a fixed number; records are counted per bucket and numbered inside it.
BUCKETS = 4096


def slot_of(text: str, slots: int = SLOTS) -> Column:
    """Virtual slot of a record: equal texts meet in one slot."""
    return F.pmod(F.xxhash64(F.lit("slot"), whole(text)), F.lit(slots))


def record_bytes(text: str) -> Column:
    """UTF-8 bytes of the text and one separator."""
    return F.octet_length(whole(text)).cast("long") + 1


def first_map(slots: int, shards: int) -> dict[int, int]:
    """Version 0: slots dealt out in turn, before anything is known about the data."""
    return {s: s % shards for s in range(slots)}


def rebalance(old: dict[int, int], weights: dict[int, int], shards: int, tolerance: float = 0.001) -> dict[int, int]:
    """The next version of the map: as few slots as needed move from shards above the mean to shards below it.

    Slots on shards that no longer exist move first. Then the fullest shard gives the emptiest one the largest slot
    that narrows the gap between them, until every shard is within ``tolerance`` of the mean or no move helps; a shard
    that has no such slot (one very long document) is left, and the others go on. The work is on one number per slot, of
    which there is a fixed count.
    """
    new = dict(old)
    load = dict.fromkeys(range(shards), 0)
    for s, k in new.items():
        if k in load:
            load[k] += weights.get(s, 0)
    for s in sorted((s for s, k in new.items() if k not in load), key=lambda s: (-weights.get(s, 0), s)):
        new[s] = min(load, key=lambda k: (load[k], k))
        load[new[s]] += weights.get(s, 0)
    mean = sum(load.values()) / max(1, shards)
    stuck: set[int] = set()
    for _ in range(4 * len(new)):
        high, low = max(load.keys() - stuck, key=lambda k: (load[k], -k)), min(load, key=lambda k: (load[k], k))
        gap = load[high] - load[low]
        if load[high] <= mean * (1 + tolerance) and load[low] >= mean * (1 - tolerance):
            break
        movable = [s for s, k in new.items() if k == high and 0 < weights.get(s, 0) < gap]
        if not movable:
            stuck.add(high)
            if len(stuck) == len(load):
                break
            continue
        s = min(movable, key=lambda s: (abs(gap / 2 - weights[s]), s))
        new[s] = low
        load[high] -= weights[s]
        load[low] += weights[s]
    return new


def save_map(spark: SparkSession, path: str, version: int, shards: int, assignment: dict[int, int],
             weights: dict[int, int]) -> None:
    """Store one version of the map: a row per slot under ``path/version=N``; earlier versions stay readable."""
    rows = [(s, k, weights.get(s, 0)) for s, k in sorted(assignment.items())]
    (spark.createDataFrame(rows, "slot long, shard int, bytes long").withColumn("shards", F.lit(shards)).coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/version={version}"))


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version}")


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8,
                    slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Assign every record to a shard of near equal bytes and number the records of a shard from 0.

    Records are hashed by their text into ``slots`` virtual slots, bytes are summed per slot, and the slot-to-shard map
    (version 0: slots in turn) is edited into version 1, which the records then follow; both versions are stored under
    ``map_path``. Only the per-slot sums (a fixed number) reach the driver, and the map goes back as a join side of
    that fixed size. A slot above a shard's fair share of the bytes is cut into parts that are moved on their own by their
    measured bytes (a fixed number of sums too). Equal texts stay in one part and so in one shard, but for a text whose rows
    alone exceed a fair share: they are dealt out by row. One document is never cut.

    Adds ``size``, ``text_crc32``, ``virtual_slot``, ``shard`` and ``slot`` (the place in the shard: a running count
    over a fixed number of hash buckets, then within each bucket). The texts are not shuffled; the result is
    ``id_col`` and the added columns.

    Defined cases: a null text has size 1 and the checksum of an empty text; repeated rows are all placed; null ids
    are placed like any other; an empty table gives no rows but still stores a map; further columns are ignored.
    """
    spark = docs.sparkSession
    map_path = map_path or f"{checkpoint_dir(spark).rstrip('/')}/slot-map-{uuid.uuid4().hex[:12]}"
    k1, k2 = content_key(text_col)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"),
                       slot_of(text_col, slots).alias("v"), record_bytes(text_col).alias("size"),
                       F.crc32(whole(text_col)).alias("text_crc32"))
    rows = materialize(rows, "shard-rows")  # slim, and the row numbers stay what they are
    bytes_of = dict(rows.groupBy("v").agg(F.sum("size")).collect())  # at most ``slots`` rows
    fair = sum(bytes_of.values()) / shards
    parts = {v: int(16 * b / fair) if b > fair else 1 for v, b in bytes_of.items()}
    hot = [(v, n) for v, n in parts.items() if n > 1]  # fewer than ``shards``
    weights = {v: bytes_of.get(v, 0) for v in range(slots)}
    rows = rows.withColumn("part", F.lit(0).cast("long"))
    if hot:
        cut = F.broadcast(spark.createDataFrame(hot, "h_v long, n long"))
        inside = rows.join(cut, F.col("v") == F.col("h_v"))
        # texts that alone exceed a fair share, fewer than ``shards``: only they are cut, by the row; all others stay whole
        large = [(r.k1, r.k2) for r in inside.groupBy("v", "k1", "k2").agg(F.sum("size").alias("b"))
                 .where(F.col("b") > F.lit(fair)).select("k1", "k2").collect()]
        big = F.broadcast(spark.createDataFrame(large, "b_k1 long, b_k2 long"))
        dealt = inside.join(big, (F.col("k1") == F.col("b_k1")) & (F.col("k2") == F.col("b_k2")), "left")
        unit = F.when(F.col("b_k1").isNotNull(), F.xxhash64(F.lit("part"), "row")).otherwise(F.xxhash64(F.lit("part"), "k1", "k2"))
        dealt = materialize(dealt.withColumn("part", F.pmod(unit, F.col("n"))).select(*rows.columns), "hot-slots")
        measured = {(r.v, r.part): r.b for r in dealt.groupBy("v", "part").agg(F.sum("size").alias("b")).collect()}
        weights |= {slots * p + v: measured.get((v, p), 0) for v, n in hot for p in range(n)}
        rows = rows.join(cut, F.col("v") == F.col("h_v"), "left_anti").unionByName(dealt)
    old = {u: (u % slots) % shards for u in weights}
    new = rebalance(old, weights, shards)
    save_map(spark, map_path, 0, shards, old, weights)
    save_map(spark, map_path, 1, shards, new, weights)

    by_slot = (load_map(spark, map_path, 1).groupBy(F.pmod("slot", F.lit(slots)).alias("m_v"))
               .agg(F.sort_array(F.collect_list(F.struct("slot", "shard"))).alias("units")))
    placed = rows.join(F.broadcast(by_slot), F.col("v") == F.col("m_v"))  # one row per virtual slot
    placed = placed.select("row", "id", "size", "text_crc32", F.col("v").alias("virtual_slot"),
                           F.get("units", F.col("part").cast("int"))["shard"].alias("shard"),
                           F.pmod(F.xxhash64(F.lit("place"), "row"), F.lit(BUCKETS)).alias("bucket"))
    starts = (placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
              .select(F.col("shard").alias("s_shard"), F.col("bucket").alias("s_bucket"),
                      (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("start")))
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("row"))
    return (placed.withColumn("i", inside)
            .join(starts, (F.col("shard") == F.col("s_shard")) & (F.col("bucket") == F.col("s_bucket")))
            .select(F.col("id").alias(id_col), "size", "text_crc32", "virtual_slot", "shard",
                    (F.col("start") + F.col("i") - 1).alias("slot")))
