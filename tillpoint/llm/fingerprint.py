"""Document fingerprints from closed syncmers, and the likeness of neighbouring documents."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Code points of a k-mer and of the inner substrings whose least hash decides about it: 2 of K - S + 1 k-mers are anchors.
#: An anchor takes seven bytes or eight, so that a fingerprint is about half as long as its text.
K, S = 40, 9
_BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 20
_DIGITS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _windows(codes: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every run of ``n`` code points (products wrap at 64 bits)."""
    h = np.zeros(len(codes) - n + 1, np.uint64)
    for i in range(n):
        h *= np.uint64(_BASE)
        h += codes[i:len(codes) - n + 1 + i]
    return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    span = 1
    while span < width:
        step = min(span, width - span)
        x = np.minimum(x[:-step], x[step:])
        span += step
    return x


def syncmers(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the closed syncmers of the whole text.

    A k-mer is one if the least of its inner s-mers is its first or its last, which only its own characters decide. A
    text shorter than a k-mer is one anchor at 0; an empty one has none.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    if not len(codes):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    if len(codes) < K:
        return (_mix(_windows(codes, len(codes))) >> np.uint64(32)).astype(np.uint32), np.zeros(1, np.int64)
    hashes, places = [], []
    for at in range(0, len(codes) - K + 1, _CHUNK):  # chunks overlap by a k-mer, so that very long texts fit
        part = codes[at:at + _CHUNK + K - 1]
        inner = _mix(_windows(part, S))
        least = _sliding_min(inner, K - S + 1)
        chosen = np.flatnonzero((inner[:len(least)] == least) | (inner[K - S:] == least))
        h = np.zeros(len(chosen), np.uint64)
        for i in range(K):
            h *= np.uint64(_BASE)
            h += part[chosen + i]
        hashes.append((_mix(h) >> np.uint64(32)).astype(np.uint32))
        places.append(chosen + at)
    return np.concatenate(hashes), np.concatenate(places)


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """All closed syncmers of the text, each content once at its first position, in order of the hash."""
    h, pos = syncmers(text)
    h, first = np.unique(h, return_index=True)
    return h, pos[first]


def encode(found: tuple[np.ndarray, np.ndarray]) -> str:
    """Anchors as text, in order of position: six base-64 digits of the hash, then the gap to the anchor before.

    A gap is written in base-64 digits of five bits each, lowest first; the sixth bit says that another digit follows.
    """
    order = np.argsort(found[1], kind="stable")
    h, pos = found[0][order].astype(np.int64), found[1][order]
    if not len(h):
        return ""
    gap = np.diff(pos, prepend=0)
    width = max(1, -(-int(gap.max()).bit_length() // 5))
    digits = np.empty((len(h), 6 + width), np.int64)
    digits[:, :6] = (h[:, None] >> np.arange(30, -6, -6)) & 63
    rest = gap[:, None] >> (5 * np.arange(width))
    digits[:, 6:] = (rest & 31) | np.where(rest >> 5 > 0, 32, 0)
    shown = np.ones(digits.shape, bool)
    shown[:, 7:] = rest[:, 1:] > 0
    return _DIGITS[digits[shown]].tobytes().decode("ascii")


def decode(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of an encoded fingerprint, in order of the hash."""
    value = {c: i for i, c in enumerate(_DIGITS.tobytes().decode("ascii"))}
    h, pos, at = [], [], 0
    while at < len(text):
        n = 0
        for c in text[at:at + 6]:
            n = n << 6 | value[c]
        at, shift, gap = at + 6, 0, 0
        while True:
            d = value[text[at]]
            at, gap, shift = at + 1, gap | (d & 31) << shift, shift + 5
            if not d & 32:
                break
        h.append(n)
        pos.append(gap + (pos[-1] if pos else 0))
    order = np.argsort(np.array(h, np.uint32), kind="stable")
    return np.array(h, np.uint32)[order], np.array(pos, np.int64)[order]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Share of the anchors of both texts' union that match in both content and order, between 0 and 1.

    All anchors count, at any length. Of those in both texts, the longest run whose positions rise in both counts, so
    passages in another order do not. Two empty texts have likeness 1.
    """
    if not len(a[0]) and not len(b[0]):
        return 1.0
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    pa, pb = a[1][ia], b[1][ib]
    ends: list[int] = []  # longest rising subsequence
    for p in pb[np.argsort(pa, kind="stable")].tolist():
        if not ends or p > ends[-1]:
            ends.append(p)
        else:
            ends[bisect_left(ends, p)] = p
    return len(ends) / (len(a[0]) + len(b[0]) - len(ia))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many first code points of the next one (or all of it)."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


SCHEMA = ("id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compare(key, text: str, own, following: str, following_anchors) -> tuple:
    other = edited(text, following)
    changed = anchors(other)
    return (key, len(text), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(), encode(own),
            encode(changed), likeness(own, changed), likeness(own, following_anchors))


def _ranges(rows: DataFrame, n: int) -> list[tuple]:
    """First key (id, hash of the text) of each of at most ``n`` ranges of about equal row counts, descending.

    Only keys are shuffled; ``n`` keys at most reach the driver.
    """
    keys = rows.select(F.struct("id", _start().alias("p")).alias("key"))
    dealt = keys.repartitionByRange(n, F.col("key.id").desc_nulls_last(), F.col("key.p").desc())
    firsts = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.max("key").alias("key")).collect()
    return sorted(((r.key.id is not None, r.key.id, r.key.p) for r in firsts), reverse=True)


def _start():
    """A hash of the whole text: parts rows that share an id, however their texts begin."""
    return F.xxhash64(F.lit("order"), "t")


def _with_range(rows: DataFrame, firsts: list[tuple]) -> DataFrame:
    """Rows with the number of their range."""
    ascending = firsts[::-1]

    @F.arrow_udf("int")
    def place(ids: pa.Array, starts: pa.Array) -> pa.Array:
        return pa.array([max(0, len(ascending) - 1 - bisect_left(ascending, (i is not None, i, p)))
                         for i, p in zip(ids.to_pylist(), starts.to_pylist())], pa.int32())

    return rows.withColumn("part", place("id", _start()))


def _stream(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            out = []
            kind = batch.schema.field("id").type
            for i, text in enumerate(batch.column("t").to_pylist()):
                own = anchors(text)
                if before:
                    out.append(_compare(*before, text, own))
                before = (batch.column("id")[i].as_py(), text, own)
            kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            values = zip(*out) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=columns)
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 partitions: int | None = None) -> DataFrame:
    """Fingerprint every whole text, its edited text, and compare it with both that and the next document.

    The next document is the one after it by descending id, then descending hash of the text (equal rows follow each other);
    after the last comes the first. A pass over keys cuts the order into ranges. One shuffle brings each range, and a copy
    of the first row of the range after it, into one partition; there each text meets the next in a stream, one text
    held at a time. No order runs through one task and nothing is written in between. Fingerprints grow with the text: one
    anchor for about (K - S + 1) / 2 code points, at every length. Rows equal in both id and text are one range.

    Defined cases: null texts count as empty; repeated rows each come out, and are each other's next; null ids come
    last; a single row is its own next; an empty table gives none; further columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    firsts = _ranges(rows, n)
    # the first row of every range goes to the range before it (of the first one: to the last), after its own rows
    heads = spark.createDataFrame([(i, p, (at or len(firsts)) - 1) for at, (_, i, p) in enumerate(firsts)],
                                  f"h_id {kind}, h_start long, part int")
    copies = (rows.join(F.broadcast(heads), F.col("id").eqNullSafe(F.col("h_id")) & (_start() == F.col("h_start")))
              .groupBy("part").agg(F.max(F.struct("id", _start().alias("p"), "t")).alias("head"))
              .select("head.id", "head.t", "part", F.lit(1).alias("copy")))
    dealt = (_with_range(rows, firsts).withColumn("copy", F.lit(0)).unionByName(copies)
             .repartitionById(n, F.col("part"))
             .sortWithinPartitions("copy", F.col("id").desc_nulls_last(), _start().desc(), F.col("t").desc()))
    columns = [f.split(" ")[0] for f in SCHEMA.format(kind=kind).split(", ")]
    out = dealt.select("id", "t").mapInArrow(_stream(columns), SCHEMA.format(kind=kind))
    return out.withColumnRenamed("id", id_col)
