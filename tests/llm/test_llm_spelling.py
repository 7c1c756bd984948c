"""Spelling variants: filters, edits, and whole results against a plain version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillpoint.llm import queries, spelling
from tillpoint.llm.common import prepare

SF = "/root/testdata/sf0.001"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SMALL = str.maketrans(UPPER, UPPER.lower())


def plain_words(docs, drop_every=31):
    out = Counter()
    for i, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(SMALL)):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            out[w[:h % len(w)] + w[h % len(w) + 1:] if drop_every and h % drop_every == 0 else w] += 1
    return out


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(vocab, ratio=10):
    near, by_size = {}, {}
    for w in vocab:
        by_size.setdefault(len(w), []).append(w)
    for w in vocab:
        near[w] = [x for n in (len(w) - 1, len(w), len(w) + 1) for x in by_size.get(n, ()) if is_near(w, x)]
    form = {}
    for w, n in vocab.items():
        best = min(near[w], key=lambda x: (-vocab[x], x), default=None)
        form[w] = best if best is not None and vocab[best] >= ratio * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], root(w), n, len(near[w]), vocab.get(form[w])) for w, n in vocab.items()}


def rows(df):
    got = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_query_against_plain_version(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    vocab = {w: n for w, n in plain_words(docs).items() if len(w) >= 7 and n >= 2}
    assert rows(queries.QUERIES["op13_spelling_variants"](spark, SF)) == plain(vocab)
    assert len(vocab) > 1000


@pytest.mark.parametrize("limit", [spelling.FILTER_WORDS, 40])
def test_variants_of_random_words(spark, limit):
    prepare(spark)
    rng = random.Random(6)
    vocab = {"".join(rng.choice("abcé") for _ in range(rng.randint(1, 5))): 10 ** rng.randint(0, 5) for _ in range(300)}
    vocab |= {"": 3, "x" * 3000: 500, "x" * 2999: 5, "x" * 3000 + "y": 5, "日本": 2, "日木": 30, "\U0001f600a": 4, "\U0001f600b": 44}
    chain = {"zzzzzzzz"[:k] + "q" * (20 - k): 10 ** (k - 1) for k in range(1, 9)}  # each is the form of the one before
    vocab |= chain
    table = spark.createDataFrame(list(vocab.items()), "word string, n long").withColumns(
        {c: F.lit(1) for c in ("form", "near", "h", "other", "size")})
    got = rows(spelling.variants(table, filter_words=limit))
    assert got == plain(vocab)
    assert next(r[2] for r in got if r[0] == "z" + "q" * 19) == "z" * 8 + "q" * 12


def test_edges(spark):
    prepare(spark)
    data = [(1, "Färbung FÄRBUNG färbung; abcdefg-abcdefgh"), (None, "abcdefg abcdefg×÷ÿ"), (3, None), (4, ""), (4, "1 2 3"),
            (5, "Abcdefg Abcdefg"), (5, "Abcdefg Abcdefg"), (6, "q" * 60_000 + " " + "q" * 60_000)]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumns(
        {c: F.lit(7) for c in ("word", "n", "h", "i", "form", "root", "near")})
    for drop in (0, 1, 2, 31):
        vocab = {w: n for w, n in plain_words(data, drop).items() if len(w) >= 7 and n >= 2}
        assert rows(spelling.group_variants(docs, drop_every=drop)) == plain(vocab)
    assert rows(spelling.group_variants(docs.where("false"))) == set()


def test_filters_miss_nothing():
    rng = np.random.default_rng(8)
    words = ["".join(map(chr, rng.integers(97, 123, 9))) for _ in range(5000)]
    codes = spelling._codes(words)
    h = spelling.hashes(codes)
    w, at, gone = spelling.deletions(codes[:50])
    assert (gone == spelling.hashes(spelling._codes([words[k][:i] + words[k][i + 1:] for k, i in zip(w, at)]))).all()
    letters = np.sort(spelling._codes(["abcxyz"])[0])
    w, at, c, new = spelling.replacements(codes[:50], letters)
    made = [words[k][:i] + "abcxyz"[j] + words[k][i + 1:] for k, i, j in zip(w, at, c)]
    assert (new == spelling.hashes(spelling._codes(made))).all() and all(m > words[k] for m, k in zip(made, w))
    for limit in (1 << 20, 1300):
        hits = np.zeros(0, int)
        for layout in spelling.layouts({9: 5000, 4: 10}, limit):
            cells = np.zeros(layout.blocks * spelling.CELLS, np.uint64)
            for at, block in spelling._by_part(h, 9, layout):
                for k in range(spelling.PROBES):
                    bit = spelling._bit(h[at], k)
                    cell = block * spelling.CELLS + (bit >> np.uint64(6)).astype(int)
                    np.bitwise_or.at(cells, cell, np.uint64(1) << (bit & np.uint64(63)))
            hits = np.r_[hits, spelling.has(cells, layout, h, 9)]
            others = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
            assert len(spelling.has(cells, layout, others, 9)) < 300
        assert sorted(hits) == list(range(5000))
