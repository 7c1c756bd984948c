"""Small labelled pages for the block classifier: invented layouts whose main blocks are known."""

from __future__ import annotations

import numpy as np

_SYLLABLES = "ba ko ri tel um san dor vi le pa mo ne shi gra lin".split()
#: (before the article, article pattern, after it); {0}.. are main blocks, {a}.. other texts, {l} a list of links.
_FRAMES = [
    "<header><h1>{a}</h1><nav><ul>{l}</ul></nav></header>", "<nav><ul>{l}</ul></nav><div class='ad'>{b}</div>",
    "<div id='header'>{a}</div><div class='menu'>{l}</div><p class='cookie-notice'>{b}</p>", "<div>{l}</div>",
    "<div role='banner'><p>{a}</p></div><aside class='sidebar'><h3>{c}</h3><p>{b}</p></aside>",
    "<form action='/q'><label>{c}</label><p>{b}</p><button>{c}</button></form><div><a href='/'>{c}</a></div>",
]
_ENDS = [
    "<footer><p>{a}</p>&copy; {c}</footer>", "<section class='comments'><h2>{c}</h2><p>{b}</p><p>{c}</p></section>",
    "<div id='footer'>{l}{a}</div>", "<aside><p>{b}</p></aside><footer>{c}</footer>",
    "<ul class='related'>{l}</ul><div class='sponsored'><p>{b}</p></div><footer>&copy; {a}</footer>",
    "<div class='newsletter'><p>{b}</p></div><div id='comments'><p>{b}</p><p>{a}</p></div>", "<div>{l}</div>",
]
_ARTICLES = [
    ("<article>", "</article>"), ("<main>", "</main>"), ("<div class='content'>", "</div>"),
    ("<div id='article-body'>", "</div>"), ("<article class='post'><header>", "</header></article>"),
    ("<div>", "</div>"), ("", ""),
]


#: (before the article, after it) of pages whose names tell states and parts of the article: {h} the title, {m} its blocks.
_NAMED = [
    ("<body class='page has-sidebar'><div id='header'>{a}</div><div class='content'><h1>{h}</h1>{m}</div>",
     "<div class='sidebar'><p>{b}</p></div><footer>{c}</footer></body>"),
    ("<body><nav><ul>{l}</ul></nav><article class='post comments-open'><h1>{h}</h1>{m}</article>",
     "<div class='comment-list'><p>{b}</p></div><footer>{a}</footer></body>"),
    ("<body class=comments-open><div class='site-header'>{a}</div><article><div class='post-header'><h1>{h}</h1></div>{m}",
     "</article><aside><p>{b}</p></aside></body>"),
    ("<html class='no-js'><body class='with-sidebar'><div id='page' class='layout-sidebar-right'><main><h1>{h}</h1>{m}</main>",
     "<div class='cookie-notice'><p title=it's>{b}</p></div></div></body></html>"),
]


#: Pages whose names tell nothing, in every combination of (before the article, after it); the article is plain text or a div.
_UNNAMED = [
    ("<div class=x1><div class=k><a href='/'>{c}</a></div><ul class=u7>{l}</ul></div>", "<div class=z3><ul>{l}</ul><p>{c}</p></div>"),
    ("<div class='a9'>{l}</div><div class='b2'><p>{c}</p></div>", "<div class='q4'><a href='/x'>{a}</a></div><div class='q5'>{l}</div>"),
    ("<table><tr><td>{l}</td></tr></table>", "<p><a href='/1'>{c}</a> <a href='/2'>{c}</a></p><p>{c}</p>"),
    ("", "<div class=w><ul>{l}</ul></div>"), ("", ""),
    ("<form action='/page'><div class=t><a href='/'>{c}</a></div>", "<div class=w><ul>{l}</ul></div></form>"),
]


#: What a main block of a labelled page ends with; all other blocks end with a full stop.
LABEL = ";"


def _words(rng: np.random.Generator, n: int, end: str = ".") -> str:
    return " ".join("".join(rng.choice(_SYLLABLES, rng.integers(1, 4))) for _ in range(n)).capitalize() + end


def labelled_pages(seed: int = 5, pages: int = 168) -> list[str]:
    """Pages of every combination of layouts, with main blocks from one word to a few hundred."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(pages):
        start, end = _FRAMES[i % len(_FRAMES)], _ENDS[i // 2 % len(_ENDS)]
        opening, closing = _ARTICLES[i // 3 % len(_ARTICLES)]
        sizes = [int(x) for x in rng.choice([1, 2, 4, 9, 30, 80, 200], rng.integers(2, 7))]
        main = [_words(rng, n, LABEL) for n in sizes]
        title = _words(rng, int(rng.choice([1, 2, 6])), LABEL)
        links = "".join(f"<li><a href='/{j}'>{_words(rng, int(rng.integers(1, 4)))}</a></li>" for j in range(6))
        fill = {"a": _words(rng, 8), "b": _words(rng, int(rng.choice([4, 12, 40, 110]))), "c": _words(rng, 3), "l": links}
        body = "".join(f"<p>{m}</p>" if rng.random() < 0.9 else f"<ul><li>{m}</li></ul>" for m in main)
        html = (f"<!DOCTYPE html><html><head><title>{title}</title></head><body>{start.format(**fill)}"
                f"{opening}<h1>{title}</h1>{body}{closing}{end.format(**fill)}</body></html>")
        out.append(html)
    for i in range(24):
        start, end = _NAMED[i % len(_NAMED)]
        main = "".join(f"<p>{_words(rng, int(n), LABEL)}</p>" for n in rng.choice([1, 2, 4, 9, 30, 80], rng.integers(2, 6)))
        links = "".join(f"<li><a href='/{j}'>{_words(rng, 2)}</a></li>" for j in range(6))
        out.append((start + end).format(h=_words(rng, int(rng.choice([1, 2, 6])), LABEL), m=main, l=links, a=_words(rng, 8),
                                        b=_words(rng, int(rng.choice([20, 90]))), c=_words(rng, 3)))
    for i in range(60):
        start, end = _UNNAMED[i % len(_UNNAMED)]
        opening, closing = [("<div class=c8>", "</div>"), ("", "")][i // 6 % 2]
        title = "<h1>{h}</h1>" if i % 5 else ""
        main = "".join(f"<p>{_words(rng, int(n), LABEL)}</p>" for n in rng.choice([9, 14, 30, 80, 200], rng.integers(3, 7)))
        links = "".join(f"<li><a href='/{j}'>{_words(rng, int(rng.integers(1, 4)))}</a></li>" for j in range(6))
        out.append((start + opening + title + "{m}" + closing + end).format(
            h=_words(rng, 7, LABEL), m=main, l=links, a=_words(rng, 8), c=_words(rng, 3)))
    for n in (1, 2, 3, 5, 8, 14, 40, 70, 120):  # text without any markup, and a single block
        out += [_words(rng, n, LABEL), f"<p>{_words(rng, n, LABEL)}</p>", f"<div class=c><p>{_words(rng, n, LABEL)}</p></div>"]
    return out
