"""Grouping of spelling variants: generated edits probe length-sharded Bloom filters, an exact join confirms them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import LOWER, UPPER
from tillpoint.session import materialize

#: Maximal runs of these letters are words.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Words that one broadcast filter holds at most, bits for each, and bits set in a word's block: 16 MB, whatever the
#: vocabulary; a larger one takes several filters, one after the other.
FILTER_WORDS, WORD_BITS, PROBES = 1 << 23, 16, 6
#: 64-bit cells of a block, and blocks that one task fills.
CELLS, CHUNK = 8, 4096
#: Generated edits that a task holds at a time, about.
EDITS = 1 << 21
#: Words of a probing task, about.
TASK_WORDS = 8192
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int = 0) -> DataFrame:
    """(word) for every run of letters of every whole text, A-Z lower-cased; null texts have none.

    With ``drop_every`` some occurrences lose one letter, as typing slips do: where that number divides the CRC-32 h of
    ``<id>:<word>`` (a null id is empty), the letter at h modulo the word's length goes.
    """
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"),
                       F.explode(F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(LETTERS), F.lit(0)))
                       .alias("word"))
    if not drop_every:
        return runs.select("word")
    runs = runs.withColumn("h", F.crc32(F.concat_ws(":", "i", "word").cast("binary")))
    at = (F.col("h") % F.length("word")).cast("int")
    slip = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return runs.select(F.when(F.col("h") % drop_every == 0, slip).otherwise(F.col("word")).alias("word"))


def vocabulary(occurrences: DataFrame, least_length: int = 7, least_count: int = 2) -> DataFrame:
    """(word, n) of the distinct words that are long and frequent enough; summed per task before the shuffle."""
    return (occurrences.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least_count))


# ---- hashes of words and of their edits ----------------------------------------------------------------------------
def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _BASE, np.uint64)]) if n else np.zeros(0, np.uint64)


def _codes(same_length: list[str]) -> np.ndarray:
    data = "".join(same_length).encode("utf-32-le")
    return np.frombuffer(data, "<u4").astype(np.uint64).reshape(len(same_length), len(same_length[0])) + np.uint64(1)


def hashes(codes: np.ndarray) -> np.ndarray:
    return _mix((codes * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64))


def deletions(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, place, hash) of every word less one letter; of equal neighbours only the first goes."""
    terms = codes * _powers(codes.shape[1])
    sums = np.cumsum(terms, axis=1, dtype=np.uint64)
    h = sums - terms + (sums[:, -1:] - sums) * np.uint64(_INVERSE)
    first = np.ones(codes.shape, bool)
    first[:, 1:] = codes[:, 1:] != codes[:, :-1]
    w, at = np.nonzero(first)
    return w, at, _mix(h[w, at])


def replacements(codes: np.ndarray, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word number, place, letter number, hash) of every word with one letter replaced by a greater one: of two words
    that differ so, one finds the other."""
    power = _powers(codes.shape[1])
    h = (codes * power).sum(axis=1, dtype=np.uint64)
    w, at, letter = np.nonzero(alphabet[None, None, :] > codes[:, :, None])
    return w, at, letter, _mix(h[w] + (alphabet[letter] - codes[w, at]) * power[at])


# ---- blocked Bloom filters -----------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Layout:
    """Where the filters of one pass lie: for (length, part) the first block and the number of blocks."""

    parts: dict[int, int]  # hash parts of the words of a length
    place: dict[tuple[int, int], tuple[int, int]]
    blocks: int


def layouts(counts: dict[int, int], limit: int = FILTER_WORDS) -> list[Layout]:
    """Filters of all lengths, dealt to passes of at most ``limit`` words; a length of more words is cut by hash."""
    parts = {n: -(-c // limit) for n, c in counts.items()}
    passes, place, blocks, held = [], {}, 0, 0
    for n in sorted(counts):
        for p in range(parts[n]):
            mine = -(-counts[n] // parts[n])
            if held and held + mine > limit:
                passes.append(Layout(parts, place, blocks))
                place, blocks, held = {}, 0, 0
            size = -(-mine * WORD_BITS // (64 * CELLS))
            place[n, p] = (blocks, size)
            blocks, held = blocks + size, held + mine
    return [*passes, Layout(parts, place, blocks)] if place else passes


def _block(h: np.ndarray, first: int, size: int) -> np.ndarray:
    return first + ((h >> np.uint64(32)) % np.uint64(size)).astype(np.int64)


def _bit(h: np.ndarray, k: int) -> np.ndarray:
    return _mix(h + np.uint64(k)) & np.uint64(64 * CELLS - 1) if k >= PROBES // 2 else (
        h >> np.uint64(9 * k)) & np.uint64(64 * CELLS - 1)


def _by_part(h: np.ndarray, length: int, layout: Layout) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers, blocks) of the hashes of words of ``length`` that this pass has a filter for."""
    n = layout.parts.get(length, 0)
    part = (_mix(h ^ np.uint64(_BASE)) % np.uint64(n)).astype(np.int64) if n > 1 else None
    for p in range(n):
        if (length, p) in layout.place:
            at = np.arange(len(h)) if part is None else np.flatnonzero(part == p)
            yield at, _block(h[at], *layout.place[length, p])


def has(cells: np.ndarray, layout: Layout, h: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the hashes that the filter of ``length`` may hold."""
    found = []
    for at, block in _by_part(h, length, layout):
        for k in range(PROBES):  # most fall out at the first bits
            bit = _bit(h[at], k)
            on = (cells[block * CELLS + (bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
            at, block = at[on], block[on]
        found.append(at)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _by_length(texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    for n in np.unique(size):
        yield int(n), np.flatnonzero(size == n)


def fill(vocab: DataFrame, layout: Layout) -> np.ndarray:
    """The cells of one pass: words go to the chunk of blocks that holds theirs, every chunk is filled in its task."""
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["word"].tolist()
            for n, rows in _by_length(texts):
                h = hashes(_codes([texts[i] for i in rows]))
                for at, block in _by_part(h, n, layout):
                    yield pd.DataFrame({"chunk": block // CHUNK, "block": block, "h": h[at].view(np.int64)})

    def chunk(pdf: pd.DataFrame) -> pd.DataFrame:
        first = int(pdf["chunk"].iloc[0]) * CHUNK
        cells, h = np.zeros(CHUNK * CELLS, np.uint64), pdf["h"].to_numpy(np.int64).view(np.uint64)
        for k in range(PROBES):
            bit = _bit(h, k)
            cell = (pdf["block"].to_numpy() - first) * CELLS + (bit >> np.uint64(6)).astype(np.int64)
            np.bitwise_or.at(cells, cell, np.uint64(1) << (bit & np.uint64(63)))
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "cells": [cells.tobytes()]})

    out = np.zeros(-(-layout.blocks // CHUNK) * CHUNK * CELLS, np.uint64)
    filled = (vocab.select("word").mapInPandas(place, "chunk long, block long, h long").groupBy("chunk")
              .applyInPandas(chunk, "chunk long, cells binary"))
    for r in filled.toLocalIterator():  # the proven bound of a filter
        out[r["chunk"] * CHUNK * CELLS:(r["chunk"] + 1) * CHUNK * CELLS] = np.frombuffer(r["cells"], np.uint64)
    return out


def candidates(vocab: DataFrame, layout: Layout, cells: np.ndarray, alphabet: str) -> DataFrame:
    """(word, n, other): edits of the words that the filters of this pass may hold, as strings."""
    shared = vocab.sparkSession.sparkContext.broadcast(cells)
    letters = np.sort(_codes([alphabet])[0]) if alphabet else np.zeros(0, np.uint64)

    new = [chr(int(c) - 1) for c in letters]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        for batch in batches:
            every, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            for n, rows in _by_length(every):
                step = max(1, EDITS // max(1, n * len(letters)))
                for at in range(0, len(rows), step):
                    part = rows[at:at + step]
                    texts = [every[i] for i in part]
                    codes, out = _codes(texts), []
                    w, place, h = deletions(codes)
                    hit = has(filters, layout, h, n - 1)
                    out += [(k, texts[k][:i] + texts[k][i + 1:]) for k, i in zip(w[hit].tolist(), place[hit].tolist())]
                    w, place, letter, h = replacements(codes, letters)
                    hit = has(filters, layout, h, n)
                    out += [(k, texts[k][:i] + new[c] + texts[k][i + 1:])
                            for k, i, c in zip(w[hit].tolist(), place[hit].tolist(), letter[hit].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([texts[k] for k, _ in out], pa.string()),
                         pa.array([int(counts[part[k]]) for k, _ in out], pa.int64()),
                         pa.array([x for _, x in out], pa.string())], names=["word", "n", "other"])

    return vocab.select("word", "n").mapInArrow(probe, "word string, n long, other string")


def near_pairs(vocab: DataFrame, filter_words: int = FILTER_WORDS) -> DataFrame:
    """(word, n, near, near_n), in both directions: words that differ by one inserted, deleted or replaced letter.

    ``vocab`` is a written table of (word, n). Each word's deletions and replacements by letters of the vocabulary probe
    the filters; an insertion is the other word's deletion. Only what the filters may hold is shuffled, to the exact
    join with the vocabulary. Filters of more than ``filter_words`` words are broadcast one after the other.
    """
    counts = {r["size"]: r["c"] for r in vocab.groupBy(F.length("word").alias("size")).agg(F.count(F.lit(1)).alias("c")).collect()}
    alphabet = "".join(sorted(r["c"] for r in vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c"))
                              .distinct().collect() if r["c"]))
    total = sum(counts.values())
    spark = vocab.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_WORDS))
    dealt = vocab.repartition(tasks, "word")
    pairs = None
    for layout in layouts(counts, filter_words):
        maybe = candidates(dealt, layout, fill(vocab, layout), alphabet)
        sure = materialize(maybe.join(vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n")),
                                      F.col("other") == F.col("near")).select("word", "n", "near", "near_n"), "near-words")
        pairs = sure if pairs is None else pairs.unionByName(sure)
    if pairs is None:
        return spark.createDataFrame([], "word string, n long, near string, near_n long")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, from (word, form): the last word that the forms lead to.

    Every round replaces a target by the target's own target, so that the way left halves; counts rise along the way, so
    it has an end.
    """
    at = materialize(forms.select("word", F.col("form").alias("root")), "word-roots")
    while True:
        step = at.select(F.col("word").alias("s_word"), F.col("root").alias("s_root"))
        after = materialize(at.join(step, F.col("root") == F.col("s_word"), "left").select(
            "word", F.coalesce("s_root", "root").alias("root"), F.col("s_root").isNotNull().alias("moved")), "word-roots")
        at = after.select("word", "root")
        if after.where("moved").isEmpty():
            return at


def variants(vocab: DataFrame, ratio: int = 10, filter_words: int = FILTER_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``vocab`` (word, n; each word once).

    A word's form is its near word of largest n (ties: the smallest by code points) if that n is at least ``ratio``
    times its own; its root is where the forms lead, itself without one.

    Defined cases: an empty vocabulary gives none; an empty word is near to words of one letter; words without near words have n_near 0 and no form; null words take no part; further columns are ignored.
    The cost of a word grows with its length and with the number of different letters in the vocabulary.
    """
    vocab = materialize(vocab.where(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    best = near_pairs(vocab, filter_words).groupBy(F.col("word").alias("b_word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    best = vocab.join(best, F.col("word") == F.col("b_word"), "left")
    strong = -F.col("best.less") >= ratio * F.col("n")
    best = materialize(best.select("word", F.when(strong, F.col("best.near")).alias("form"), "n",
                                   F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                   F.when(strong, -F.col("best.less")).alias("form_n")), "word-forms")
    ends = roots(best.where("form IS NOT NULL")).withColumnRenamed("word", "r_word")
    return best.join(ends, F.col("word") == F.col("r_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int = 0,
                   least_length: int = 7, least_count: int = 2, ratio: int = 10) -> DataFrame:
    """``variants`` of the vocabulary of all whole texts (``words``, ``vocabulary``); columns beside id and text are ignored.

    Defined cases: null and empty texts have no words; repeated rows count repeatedly; a null id reads as an empty one; an
    empty table gives none; a run of letters of any length is one word.
    """
    return variants(vocabulary(words(docs, id_col, text_col, drop_every), least_length, least_count), ratio)
