"""Operators of the training-data subpackage: edge cases, and results against plain Python versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpoint.llm import (fingerprint, html_text, jaccard, lines, mixing, packing, quality, queries, rules, shards,
                           urls)
from tillpoint.llm.common import prepare
from tillpoint.llm.trie import PrefixTree

SF = "/root/testdata/sf0.001"
LONG = "Some long line that many documents share, word for word."
DOCS = [
    (1, "a b c d e f", "en", "src1"), (2, None, "en", "src1"), (3, "", None, "src1"), (4, "one", "de", None),
    (5, f"{LONG}\nfive own", "en", "src2"), (6, f" {LONG.upper()}\t\nsix", "en", "src2"), (7, f"{LONG}", "en", "src2"),
    (8, f"x\n{LONG}\n{LONG}", "fr", "src0"), (9, f"{LONG}\nnine\n{LONG}", "fr", "src0"), (9, f"{LONG}\nnine\n{LONG}", "fr", "src0"),
    (None, f"{LONG}\nnull id", "es", "x"), (11, "word " * 30_000, "en", "src0"), (12, "\n\n", "en", "src1"),
    (13, "A B c d e F", "en", "src1"), (14, "bé \U0001f600 İ", "es", "src3"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    extra = ("n_lines", "kept", "score", "shard", "size", "drop", "node", "comp", "id", "t", "host", "n_dropped", "pos")
    return spark.createDataFrame(DOCS, SCHEMA).withColumns({c: F.lit(7) for c in extra})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def rows_of(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


# 1 --------------------------------------------------------------------------------------------------------------
def test_url_rules(spark):
    data = [(1, "http://A.Example.ORG/en/153?x"), (2, "https://x.com/de/1#a"), (3, "https://x.com/fr/1"), (4, None),
            (5, "no scheme"), (6, "ftp://example.org"), (7, "http://notexample.org/es/1"), (8, "http:///de/1"),
            (9, "http://example.org/es/9?q=://org/"), (9, "http://example.org/es/9?q=://org/"), (None, "http://com/de/"),
            (10, "http://a.net/" + "p" * 50_000)]
    pages = spark.createDataFrame(data, "page_id long, url string").withColumns(
        {"rule": F.lit("mine"), "path": F.lit(1), "r_host": F.lit(2), "short": F.lit(3), "b_host": F.lit(4)})
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in queries.URL_RULES)
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t(host, path, verdict)")
    out = urls.filter_urls(pages, table)
    assert set(out.columns) == set(pages.columns) | {"host", "verdict"}

    def brute(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fit = [(len(h + p), h + p, v) for h, p, v in queries.URL_RULES
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, max(fit)[1], max(fit)[2]) if fit else (host, path, None, "allow")

    want = Counter((i, *brute(u)) for i, u in data)
    assert rows_of(out, "page_id", "host", "path", "rule", "verdict") == want
    assert urls.filter_urls(pages.where("false"), table).count() == 0
    assert rows_of(urls.filter_urls(pages, table.where("false")), "verdict") == Counter({("allow",): len(data)})
    tied = spark.sql("SELECT * FROM VALUES ('org','/','allow'),('org','/','block'),(null,'/','block') AS t(host,path,verdict)")
    assert {r.verdict for r in urls.filter_urls(pages.where("page_id = 1"), tied).collect()} == {"block"}


# 2 --------------------------------------------------------------------------------------------------------------
def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.QUERIES["op2_quality_classifier"](spark, sf).toPandas()
    labels = pd.read_parquet(f"{sf}/labels.parquet")
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.7)).all()
    test = out[out.held_out].merge(labels, on="doc_id")
    assert (test.predicted == test.quality).mean() > 0.93
    good, bad = test[test.quality == 1].score, test[test.quality == 0].score
    assert np.mean([(g > bad).mean() + (g == bad).mean() / 2 for g in good]) > 0.95


def test_quality_edges(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (11, 0), (None, 1), (5, None)], "doc_id long, quality int")
    assert quality.classify(docs, labels).count() == len(DOCS)
    assert {r.score for r in quality.classify(docs, labels.where("false")).collect()} == {0.5}
    assert quality.classify(empty, labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_without_a_model_all_documents_stay(spark, docs):
    held_out = next(i for i, *_ in DOCS if i and zlib.crc32(str(i).encode()) % 4 == 2)
    for rows in ([], [(999, 1)], [(held_out, 0)], [(1, None)]):
        kept = quality.keep_good(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        assert rows_of(kept, "doc_id", "text") == rows_of(docs, "doc_id", "text")


# 3 --------------------------------------------------------------------------------------------------------------
def test_rules(spark, docs, empty):
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = rules.apply_rules(docs, measures=base)
    assert set(out.columns) == set(docs.columns) | set(base)
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(DOCS) and rules.apply_rules(empty).count() == 0
    for i, text, *_ in DOCS:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        grams = Counter(zip(w, w[1:], w[2:]))
        hit = {j for k, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for j in (k, k + 1, k + 2)}
        ls = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert tuple(got[i][c] for c in base) == (
            len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(ls) - len(set(ls)), len(hit))
        assert got[i].kept == (not any(r.rejects(rules.TextMeasures(text)) for r in rules.RULES))
    assert rules.apply_rules(docs, rules=[]).where("kept").count() == len(DOCS)


# 4 --------------------------------------------------------------------------------------------------------------
def test_html(spark):
    word = "alpha beta gamma delta "
    cases = [
        (None, ""), ("", ""), ("<p>a &lt; b&amp;c &#233;\n  d</p>", "a < b&c é d"),
        (f"<nav><a href='/'>Home</a></nav><article><h1>T</h1><p>{word}<p>x<br>y</article><footer>&copy; z</footer>",
         "T\nalpha beta gamma delta\nx y"),
        (f"<header>Site</header><main><p>{word * 9}</p><div class='ad'>{word * 9}</div><p>End.</p></main>"
         f"<section id='comments'><p>{word * 20}</p></section><form><p>{word}</p></form>", (word * 9).strip() + "\nEnd."),
        ("<article><script>var a='</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>", "yes"),
        ("<article><p>kept</p><p>cut off <b", "kept\ncut off"),
        ("<article><p>" + "long " * 100_000 + "</p></article>", ("long " * 100_000).strip()),
    ]
    pages = spark.createDataFrame([(i, "u", h) for i, (h, _) in enumerate(cases)] * 2,
                                  "page_id long, url string, html string").withColumn("n_chars", F.lit("mine"))
    out = html_text.extract_text(pages)
    want = Counter((i, t, len(t)) for i, (_, t) in enumerate(cases))
    assert rows_of(out, "page_id", "text", "n_chars") == want + want
    assert html_text.extract_text(pages.where("false")).count() == 0
    x, y = html_text.labelled_table()
    half = np.arange(len(y)) % 2 == 0
    assert (html_text.train_tree(x[half], y[half]).predict(x[~half]) == y[~half]).mean() > 0.99


def test_html_names_and_quotes():
    word, tree = "alpha beta gamma delta " * 9, html_text.train_tree(*html_text.labelled_table())
    text = word.strip()
    tail = f"<div class='sidebar'><p>{word}</p></div><div class='comment-list'><p>{word}</p></div>"
    for html, want in [
        (f"<body class='page has-sidebar'><article><p>{word}</p></article>{tail}</body>", text),
        (f"<body class='page sidebar'><article class='post comments-open'><h1>T</h1><p>{word}</p></article>{tail}", f"T\n{text}"),
        (f"<main class='search'><p>{word}</p></main>{tail}", text),
        (f"<article><div class='post-header'><h1>Title</h1></div><p>{word}</p></article>{tail}", f"Title\n{text}"),
        (f"<div class='wrap with-sidebar'><div class='post tag-privacy'><p>{word}</p></div>{tail}</div>", text),
        (f"<article><p>{word}</p><div class='post-comments'><p>{word}</p></div></article>{tail}", text),
        (f"<article><p title=it's>First {word}</p><p>Second, it's fine {word}</p></article>",
         f"First {text}\nSecond, it's fine {text}"),
        (f"<article><p title='a > b' alt=\"it's\" data-x = 'y'>{word}</p></article>", text),
        (f"<article><p title='the hidden class ad'>{word}</p></article>", text),
    ]:
        assert html_text.main_text(html, tree) == want, html
    for html, want in [
        (f"<article><p>{word}</p><article class='comment'><p>{word}</p></article></article>", text),
        (f"<main><p>{word}</p></main><article class='comment-body'><p>{word}</p></article>", text),
        (f"<article><p>{word}</p></article><div class='commentList'><p>{word}</p></div><div id='cookieBanner'>{word}</div>", text),
        (f"<form action='/'><nav><a href='/'>Home</a></nav><article><p>{word}</p></article></form>", text),
        (f"<form action='/'><div><p>{word}</p><p>{word}</p></div></form>", f"{text}\n{text}"),
        (f"<div class='story social'><p>{word}</p></div><footer>x</footer>", text),
        (f"<article><p>{word}</p><video src=a><p>{word}</p><iframe src=b><p>{word}</p></article>", "\n".join([text] * 3)),
        (f"<article><p>{word}</p><video src=a><p>{word}</p><video>no</video><svg><svg></svg><text>no</text></svg><p>{word}</p>",
         "\n".join([text] * 3)),
        (f"<article><p>{word}</p><form><p>Sign up {word}</p></form><p>{word}</p><p>{word}</p></article>", "\n".join([text] * 3)),
        (f"<div class=x1><ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li></ul></div><div class=y><h1>Title of the "
         f"page here now</h1><p>{word}</p><p>{word}</p></div><div class=z><a href=/p>Privacy policy</a></div>",
         f"Title of the page here now\n{text}\n{text}"),
    ]:
        assert html_text.main_text(html, tree) == want, html
    cut = "<article><p>kept</p><b " + "a='1' " * 20_000
    assert [b.text for b in html_text.text_blocks(cut)] == ["kept"]


def test_html_tree_uses_words_and_neighbours():
    """The tree asks for words, links and neighbours; without any named element or class it still tells most blocks."""
    x, y = html_text.labelled_table()
    half, tree = np.arange(len(y)) % 2 == 0, html_text.train_tree(x, y)
    used = {html_text.FEATURES[f] for f in tree.feature if f >= 0}
    assert {"words", "link_density", "words_before"} <= used
    named = [html_text.FEATURES.index(f) for f in ("in_frame", "in_main", "page_has_main")]
    x[:, named] = 0
    assert (html_text.train_tree(x[half], y[half]).predict(x[~half]) == y[~half]).mean() > 0.9


# 5 --------------------------------------------------------------------------------------------------------------
def brute_groups(rows, n, percent):
    sets, root = [], list(range(len(rows)))
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in index[g])
        for j, o in shared.items():
            if 100 * o >= percent * (len(s) + len(sets[j]) - o):
                root[find(i)] = find(j)
        for g in s:
            index[g].append(i)
    least = defaultdict(lambda: math.inf)
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], math.inf if key is None else key)
    return [(k, len(s), k if not s or least[find(i)] == math.inf else least[find(i)])
            for i, ((k, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_jaccard_groups(spark, docs, empty, n, percent):
    rng = np.random.default_rng(n)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(words, rng.integers(1, 120))) for _ in range(40)]
    shared = " ".join(rng.choice(words, 60))
    for k in range(160):  # copies with edits, around the limit, and a passage that many share
        base = texts[int(rng.integers(0, 6))].split() if k < 110 else f"{shared} {texts[k % 40]}".split()
        for _ in range(int(rng.integers(0, 4))):
            base[int(rng.integers(0, len(base)))] = str(rng.choice(words))
        texts.append(" ".join(base))
    rows = [*enumerate(texts), *[(1000 + (i or 0), t) for i, t, *_ in DOCS], (None, texts[3]), (7, texts[7])]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit(0))
    out = jaccard.jaccard_groups(table, n=n, percent=percent)
    assert rows_of(out, "doc_id", "n_shingles", "component_id") == Counter(brute_groups(rows, n, percent))


def test_jaccard_edges(docs, empty):
    assert jaccard.jaccard_groups(empty).count() == 0
    kept = jaccard.drop_copies(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 13 not in ids and ids.count(9) == 1 and {1, 2, 3, 4, 12, None} <= set(ids)


def test_unlinked_texts_of_one_name_stay(spark):
    texts = [" ".join(f"{k}{i}" for i in range(30)) for k in "abcdef"]
    near = texts[0] + " more"
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (None, near), (5, texts[3]), (5, texts[4]), (6, texts[4]),
            (5, texts[5])]
    kept = jaccard.drop_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    left = rows_of(kept, "doc_id", "text")
    assert sum(left[None, t] for t in (texts[0], near)) == 1
    assert left - Counter([(None, texts[0]), (None, near)]) == Counter(
        [(None, texts[1]), (None, texts[2]), (5, texts[3]), (5, texts[4]), (5, texts[5])])


@pytest.mark.parametrize("limits", [
    dict(FREQUENT=2, BLOCK=8, ROUNDS=1),  # every pair goes through hubs and blocks
    dict(FREQUENT=2, BLOCK_MEMBERS=1000, ROUNDS=1, FILTER_BITS=1),  # blocks by their members, joins in place of bit filters
    dict(WINDOW=3, LISTS=16)])  # many trees of short lists
def test_limits(spark, monkeypatch, limits):
    """Limits change how pairs are found, not which."""
    for name, value in limits.items():
        monkeypatch.setattr(jaccard, name, value)
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for k in range(60):
        t = list(base)
        for i in rng.integers(0, 150, 4):
            t[i] = f"z{rng.integers(0, 9)}"
        rows += [(k, " ".join(t))] * (1 + (k % 20 == 0))  # some rows twice
    out = jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(out, "doc_id", "n_shingles", "component_id") == Counter(brute_groups(rows, 3, 90))


def test_prefix_tree():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 40))) for _ in range(120)]
    a, b = PrefixTree(sets).join(sets, 80)
    want = {(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets)
            if 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))}
    assert len(a) == len(want) and set(zip(a.tolist(), b.tolist())) == want


def test_prefix_tree_meets():
    """Lists cut at a window: the pairs whose overlap and what is left out exceed what the smaller set can spare."""
    rng = np.random.default_rng(3)
    for window in (4, 64):
        whole = [np.unique(np.r_[rng.integers(0, 2), rng.integers(2, 40, rng.integers(1, 30))]) for _ in range(80)]
        size, rest = rng.integers(20, 150, 80), np.array([max(0, len(x) - window) for x in whole])
        lists = [x[:window] for x in whole]
        want = set()
        for i in range(80):
            for j in range(i):
                low, high = sorted((int(size[i]), int(size[j])))
                common = len(np.intersect1d(lists[i], lists[j])) + max(rest[i], rest[j])
                if lists[i][0] == lists[j][0] and 100 * low >= 80 * high and common > low - -(-80 * low // 100):
                    want.add((j, i))
        a, b = PrefixTree(lists).meet(size, rest, 80)
        pairs = [tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())]
        assert len(pairs) == len(want) and set(pairs) == want
    assert len(PrefixTree([]).meet(size[:0], rest[:0], 80)[0]) == 0


# 6 --------------------------------------------------------------------------------------------------------------
def test_lines(docs, empty):
    out = lines.dedup_lines(docs)
    assert set(out.columns) == set(docs.columns)
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t, *_ in DOCS:
        for x in (t or "").split("\n"):
            holders[key(x)].add(-1 if i is None else i)
    want = Counter()
    for i, t, *_ in DOCS:
        ls = (t or "").split("\n")
        kept = [x for x in ls if len(key(x)) < 40 or len(holders[key(x)]) < 5 or max(holders[key(x)]) == i]
        want[(i, "\n".join(kept), len(ls), len(ls) - len(kept))] += 1
    assert rows_of(out, "doc_id", "text", "n_lines", "n_dropped") == want
    assert lines.dedup_lines(empty).count() == 0


# 7 --------------------------------------------------------------------------------------------------------------
def check_packing(spark, out, rows, capacity):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    want = Counter()
    for i, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for p, s in enumerate(range(0, len(ids), capacity)):
            piece = ids[s:s + capacity]
            want[(i, p, s, len(piece), zlib.crc32(piece.tobytes()))] += 1
    assert rows_of(out, "doc_id", "piece", "start", "length", "ids_crc32") == want
    bins = defaultdict(list)
    for r in out.collect():
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(k[3] * c for k, c in want.items()) // capacity)


def test_packing(spark, docs, empty, monkeypatch):
    prepare(spark)
    odd = [(100, "<|endoftext|> x \x01 y"), (101, "\x01"), (102, "ÅΣ İİ don't 12"), (103, "a\x85b c")]
    check_packing(spark, packing.pack(docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"),
                                                       allowMissingColumns=True)), [(i, t) for i, t, *_ in DOCS] + odd, 4096)
    assert packing.pack(empty).count() == 0
    monkeypatch.setattr(packing, "GROUP_PIECES", 60)
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    bins, least = check_packing(spark, packing.pack(table), rows, 4096)
    assert bins <= least + 1


def test_tokenizer_learns_letters_once(monkeypatch):
    """Letters and the punctuation after them are looked up apart, with the ids of the whole tokenizer."""
    import public_tokenizers
    tok = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    letters, signs = ["thear", "Naïve", "blend", "ÉCOLE"], [",", ".", "!!", "&&&", ";)", "<|>"]
    texts = [" ".join(a + s for s in signs) for a in letters]
    odd = ["", " \n ", "don't o'clock, it's' 's", "a=\u0338b a\u0301, x<\u0338", "a\x85b\xa0c", "\x01 x\x01, \x00", "İΣς, K. 12.5!",
           "<|endoftext|>,é<|startoftext|>", "中文, 한가.", "ª. µ, ×÷!"]
    for most in (packing.CACHED_WORDS, 5, 0):
        monkeypatch.setattr(packing, "CACHED_WORDS", most)
        tok.cache.clear()
        for texts_now in (texts, texts + odd, odd):
            got = [np.frombuffer(ids, "<u4").tolist() for ids in tok.encode(pa.array(texts_now))]
            assert got == [tok.tokenizer.encode(t, add_special_tokens=False).ids for t in texts_now]
            assert len(tok.cache) <= most
            if texts_now is texts and most > 10:
                assert len(tok.cache) == len(letters) + len(signs)
    assert tok.encode(pa.array([], pa.string())) == []


def test_portions_keep_every_row():
    batches = [pa.record_batch({"id": list(range(a, b)), "t": ["x" * (i % 90) for i in range(a, b)]})
               for a, b in ((0, 50), (50, 50), (50, 53), (53, 400))]
    for size in (1, 2000, 1 << 20):
        made = list(packing._portions(iter(batches[:1] + batches[2:]), size))
        assert [i for b in made for i in b.column("id").to_pylist()] == list(range(400))
        assert all(b.nbytes < size + 16 * 110 for b in made)
    assert list(packing._portions(iter([]), 10)) == []


def test_pieces_end_at_the_capacity(spark):
    """The end id may fill a piece, or be one of its own."""
    prepare(spark)
    rows = [(n, " ".join(["the"] * n)) for n in (0, 1, 6, 7, 8, 15, 16)] + [(None, None)]
    pieces = packing.token_pieces(spark.createDataFrame(rows, "doc_id long, text string"), capacity=8)
    the = packing.tokenizer(None).tokenizer.encode("the", add_special_tokens=False).ids
    want = Counter()
    for i, t in rows:
        ids = np.array(the * (i or 0) + [1], "<u4")
        want.update((i, p, s, len(ids[s:s + 8]), zlib.crc32(ids[s:s + 8].tobytes()))
                    for p, s in enumerate(range(0, len(ids), 8)))
    assert rows_of(pieces, "id", "piece", "start", "length", "ids_crc32") == want


def test_grouping_crossover():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 60, 80).tolist()
    a = packing.Packing(lengths, 100).best_fit(list(range(80)))
    b = packing.Packing(lengths, 100).best_fit(list(reversed(range(80))))
    for p in (packing.crossover(a, b, rng), packing.mutate(a, rng), *packing.evolve(lengths, 100, [], 1)):
        assert sorted(i for items in p.bins for i in items) == list(range(80))
        assert all(sum(lengths[i] for i in items) == 100 - r >= 0 for items, r in zip(p.bins, p.room))


# 8 --------------------------------------------------------------------------------------------------------------
def test_budgets(spark):
    rows = [("A", "x", 100), ("A", "y", 1000), ("B", "x", 50), ("B", "y", 50), (None, "x", 500)]
    units = spark.createDataFrame(rows, "d string, l string, n_tokens long")
    got = {(r.d, r.l): r.budget for r in mixing.leaf_budgets(units, ["d", "l"], {"d": {"B": 6}, "l": {"x": 3}}, 0.5, 1).collect()}
    # 850 in all: B can take 100 of its 637, the rest is halved between A and null; in A, x falls short
    assert got == {("B", "x"): 50, ("B", "y"): 50, ("A", "x"): 100, ("A", "y"): 275, (None, "x"): 375}


def test_mix(spark, docs, empty):
    args = (["lang", "source"], {"lang": {"fr": 0}}, 0.5)
    out = mixing.mix(docs, *args, max_epochs=3, seed=1)
    assert mixing.mix(empty, *args).count() == 0
    assert not {8, 9} & {r.doc_id for r in out.collect()}
    back = mixing.chosen_documents(docs, out)
    assert back.columns == docs.columns
    total = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in DOCS)
    assert out.agg(F.sum("n_tokens")).first()[0] <= total / 2


# 9 --------------------------------------------------------------------------------------------------------------
def test_fingerprints(spark, docs, empty):
    for table in (spark.read.parquet(f"{SF}/documents.parquet"), docs):
        rows = sorted(((r.doc_id, r.text or "") for r in table.select("doc_id", "text").collect()),
                      key=lambda r: -math.inf if r[0] is None else r[0], reverse=True)  # ids are unique but for equal rows
        out = fingerprint.fingerprints(table, partitions=5)
        want = Counter()
        for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
            other = fingerprint.edited(t, after)
            own, near = fingerprint.anchors(t), fingerprint.anchors(other)
            want[(i, len(t), hashlib.sha256(other.encode()).hexdigest(), fingerprint.encode(own), fingerprint.encode(near),
                  fingerprint.likeness(own, near), fingerprint.likeness(own, fingerprint.anchors(after)))] += 1
        assert rows_of(out, *out.columns) == want
    assert fingerprint.fingerprints(empty).count() == 0
    assert fingerprint.fingerprints(docs.limit(1)).first().near_next == 1.0


def test_syncmers():
    text = "".join(np.random.default_rng(2).choice(list("abcdefgh "), 3000))
    h, at = fingerprint.syncmers(text)
    inner = fingerprint._mix(fingerprint._windows(np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1),
                                                  fingerprint.S))
    width = fingerprint.K - fingerprint.S + 1
    want = [i for i in range(len(text) - fingerprint.K + 1)
            if inner[i:i + width].min() in (inner[i], inner[i + width - 1])]
    assert at.tolist() == want
    moved = set(fingerprint.syncmers("zz" + text)[0].tolist())
    assert set(h.tolist()) <= moved  # context-free
    one = fingerprint.anchors(text)
    assert fingerprint.likeness(one, one) == 1.0
    swapped = fingerprint.anchors(text[1500:] + text[:1500])
    assert fingerprint.likeness(one, swapped) < 0.8


def test_long_texts_keep_all_syncmers():
    """A small change and a shared passage show at every length."""
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcdefgh "), 120_000))
    one = fingerprint.anchors(text)
    h, at = fingerprint.syncmers(text)
    assert set(one[0].tolist()) == set(h.tolist()) and len(one[0]) > 5_000
    assert len(fingerprint.encode(one)) < 0.55 * len(text)
    changed = fingerprint.anchors(text[:60_000] + "z" * 40 + text[60_040:])
    assert fingerprint.encode(changed) != fingerprint.encode(one) and 0.998 < fingerprint.likeness(one, changed) < 1.0
    other = fingerprint.anchors("".join(rng.choice(list("abcdefgh "), 119_700)) + text[5_000:5_300])
    assert 10 / 30_000 < fingerprint.likeness(one, other) < 40 / 10_000


def test_fingerprints_decode():
    rng = np.random.default_rng(4)
    texts = ["", "a", "short text", "b" * 5000, "".join(rng.choice(list("abé \U0001f600"), 4000))]
    seen = set()
    for t in texts:
        one = fingerprint.anchors(t)
        text = fingerprint.encode(one)
        h, pos = fingerprint.decode(text)
        assert h.tolist() == one[0].tolist() and pos.tolist() == one[1].tolist()
        seen.add(text)
    far = (np.array([0, 1, 2**32 - 1], np.uint32), np.array([10**9, 0, 31], np.int64))
    assert [a.tolist() for a in fingerprint.decode(fingerprint.encode(far))] == [a.tolist() for a in far]
    assert len(seen) == len(texts)


def test_likeness_against_a_plain_version():
    """Share of the union that is matched in one order: the longest run by trying all of them."""
    rng = np.random.default_rng(5)
    for _ in range(60):
        a, b = ({int(h): int(p) for h, p in zip(rng.permutation(12)[:n], rng.permutation(40)[:n])} for n in rng.integers(0, 9, 2))
        both = sorted(a.keys() & b.keys(), key=a.get)
        runs = [[b[h] for k, h in enumerate(both) if m >> k & 1] for m in range(1 << len(both))]
        best = max(len(r) for r in runs if r == sorted(r) and len(r) == len(set(r)))
        want = best / len(a.keys() | b.keys()) if a or b else 1.0
        table = [(np.array(sorted(d), np.uint32), np.array([d[h] for h in sorted(d)], np.int64)) for d in (a, b)]
        assert fingerprint.likeness(*table) == want


# 10 -------------------------------------------------------------------------------------------------------------
def test_shards(spark, docs, empty, tmp_out):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = shards.shard_documents(table, map_path=f"{tmp_out}/map").toPandas()
    texts = table.toPandas().set_index("doc_id").text
    assert (out["size"] == [len(texts[i].encode()) + 1 for i in out.doc_id]).all()
    assert (out.text_crc32 == [zlib.crc32(texts[i].encode()) for i in out.doc_id]).all()
    load = out.groupby("shard")["size"].sum()
    assert sorted(load.index) == list(range(8)) and load.max() < 1.02 * load.min()
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert out.assign(t=[texts[i] for i in out.doc_id]).groupby("t").shard.nunique().max() == 1
    saved = shards.load_map(spark, f"{tmp_out}/map", 1).toPandas().set_index("slot").shard
    assert (out.shard == [saved[v] for v in out.virtual_slot]).all()
    edge = shards.shard_documents(docs, shards=3)
    assert edge.count() == len(DOCS) and shards.shard_documents(empty).count() == 0


def test_rebalance_moves_few_slots():
    weights = {s: 1 + s % 7 for s in range(512)}
    old = shards.rebalance(shards.first_map(512, 8), weights, 8)
    grown = shards.rebalance(old, weights, 9)
    moved = [s for s in old if old[s] != grown[s]]
    assert len(moved) < 512 / 6 and sum(grown[s] == 8 for s in moved) > 0.9 * len(moved)
    load = Counter()
    for s, k in grown.items():
        load[k] += weights[s]
    assert max(load.values()) < 1.02 * min(load.values())
    back = shards.rebalance(grown, weights, 8)
    assert 8 not in back.values() and sum(back[s] != grown[s] for s in grown if grown[s] < 8) < 512 / 8


def test_hot_text_is_split(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1500, F.lit("hot " * 20)).otherwise(
        F.concat(F.lit("t"), F.col("id"))).alias("text"))
    load = shards.shard_documents(rows, shards=4).groupBy("shard").agg(F.sum("size").alias("b")).toPandas().b
    assert len(load) == 4 and load.max() < 1.25 * load.min()


def test_only_a_text_beyond_a_share_is_split(spark):
    """Few slots and one hot text: its slot is cut, the other texts in it stay whole; rows equal in id and text spread."""
    rows = spark.range(4000).select(
        F.when(F.col("id") < 1500, F.lit(None)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") < 1500, F.lit("hot " * 30)).otherwise(F.concat(F.lit("text of a group "), F.col("id") % 400)).alias("text"))
    out = shards.shard_documents(rows, shards=4, slots=8).join(
        rows.where("doc_id IS NOT NULL").withColumnRenamed("doc_id", "d"), F.col("doc_id") == F.col("d"), "left").collect()
    where = defaultdict(set)
    for r in out:
        where[r.text].add(r.shard)
    assert len(where.pop(None)) > 1 and set(map(len, where.values())) == {1}
    for k in range(4):
        assert sorted(r.slot for r in out if r.shard == k) == list(range(sum(r.shard == k for r in out)))
    load = Counter()
    for r in out:
        load[r.shard] += r.size
    assert max(load.values()) < 1.15 * min(load.values())


def test_hot_slots_follow_measured_bytes(spark):
    """A hot text under null ids spreads; beside one very long document nothing else is placed."""
    small = spark.range(1500).select("id", F.concat(F.lit("t"), F.col("id")))
    hot = spark.range(1500).select(F.lit(None).cast("long"), F.lit("hot " * 20))
    out = shards.shard_documents(small.union(hot).toDF("doc_id", "text"), shards=4)
    load = out.groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.max("slot").alias("last")).toPandas()
    assert len(load) == 4 and load.b.max() < 1.05 * load.b.min() and (load.n == load["last"] + 1).all() and load.n.sum() == 3000
    many = spark.range(3000).select("id", F.concat(F.lit("x" * 90), F.col("id")))
    long = spark.range(1).select(F.lit(-1).cast("long"), F.lit("y" * 150_000))
    load = shards.shard_documents(many.union(long).toDF("doc_id", "text"), shards=4).groupBy("shard").agg(
        F.sum("size").alias("b")).toPandas().b.sort_values().tolist()
    assert load[3] < 1.01 * 150_001 and load[2] < 1.05 * load[0]
