"""Main text of web pages: a linear-chain CRF over the DOM's leaf blocks.

A page is cut into leaf blocks (stretches of text between block boundaries),
each with its ancestors' tags and class names. Ancestor and text features score
every block, neighbouring blocks share a transition score, and Viterbi decoding
marks the blocks of the article. The model is trained on labelled pages:
``labelled_pages`` composes them from layout parts whose label is known (a
bounded number, ``TRAINING_PAGES``), and own labelled pages may be given.

Decoding a page: character references are decoded, white space inside a block
becomes one space, kept blocks are joined in page order by one space. Whole
pages are used, of any length.

Defined results: a null, empty or text-free page gives an empty text and 0
characters; tags that are never closed, cut-off tags, comments and scripts do no
harm; repeated rows get equal results. Only the named columns are used.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from scribal.llm import crf
from scribal.llm.common import need, unused

#: Labelled pages composed for training, and the seed they are drawn with.
TRAINING_PAGES = 600
SEED = 11

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"""
    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)"""
    r"""|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# ---------------------------------------------------------------------------
# FIXED VALUES: kinds of HTML elements.
# ---------------------------------------------------------------------------
RAW_TEXT = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "select",
            "canvas", "audio", "video", "noembed", "noframes", "xmp"}
#: Of these, those that take the rest of the page when they are never closed.
TO_THE_END = {"script", "style", "title", "textarea", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
          "var", "wbr", "img", "ruby", "rb", "rt", "rp", "picture", "source", "nobr",
          # formulas, drawings and embedded objects stand in the line; what they say is text
          "math", "mi", "mo", "mn", "ms", "mtext", "mrow", "msup", "msub", "msubsup", "mfrac", "msqrt", "mroot", "mover",
          "munder", "munderover", "mfenced", "mspace", "mstyle", "mtable", "mtr", "mtd", "semantics", "annotation",
          "svg", "g", "path", "rect", "circle", "ellipse", "line", "polyline", "polygon", "text", "tspan", "textpath", "defs",
          "use", "desc", "lineargradient", "stop", "object", "param"}
#: An opening tag closes these open elements when they are the innermost block.
IMPLIED_END = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
               "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
# ---------------------------------------------------------------------------
# FIXED VALUES: families of class, id and role names. A name of five or more
# letters also stands for longer names that begin with it.
# ---------------------------------------------------------------------------
FAMILIES = {
    "menu": "nav navbar navigation menu breadcrumb crumbs topbar tabs toc pagination pager skip sitemap hamburger dropdown",
    "header": "header masthead logo branding topline",
    "footer": "footer foot copyright colophon legal contentinfo imprint",
    "side": "sidebar aside side rail widget related recommend recommended more trending popular complementary secondary "
            "teaser readnext readmore mostread latest",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup paywall "
              "privacy disclaimer banner dialog toast announcement warning flash",
    "ad": "ad ads adv advert advertisement advertising sponsor sponsored sponsors promo promotion promoted adsense dfp "
          "outbrain taboola adslot adbox adunit",
    "comment": "comment comments disqus reply replies discussion respond responses feedback commentlist",
    "form": "form search searchbox login signin contactform poll survey captcha field",
    "share": "share sharing social follow tags tag byline meta toolbar tools print",
    "main": "content article post entry main story body text page articlebody maincontent",
    "hidden": "hidden sronly visuallyhidden screenreader offscreen invisible",
}
_FAMILY_OF = {name: family for family, names in FAMILIES.items() for name in names.split()}
_STEMS = [(name, family) for name, family in _FAMILY_OF.items() if len(name) >= 5]
_TAGS = ["nav", "header", "footer", "aside", "main", "article", "section", "form", "ul", "ol", "table", "figure",
         "blockquote", "menu", "dialog", "button", "address", "details", "head", "figcaption", "fieldset", "select"]
_BLOCKS = ["p", "li", "h1", "h2", "h3", "h4", "td", "th", "div", "pre", "dd", "dt", "section", "article", "body",
           "blockquote", "figcaption", "button"]


#: What makes a block clutter also within an article.
_CLUTTER = {"comment", "ad", "share", "side", "notice", "form", "aside", "nav", "footer", "menu", "hidden", "button"}


def _family(word: str) -> str | None:
    found = _FAMILY_OF.get(word)
    if found is None and len(word) >= 5:
        found = next((f for name, f in _STEMS if word.startswith(name)), None)
    return found


@lru_cache(maxsize=50_000)
def _families(attributes: str) -> tuple[str, ...]:
    """Families named by the class, id, role and visibility of an element."""
    if "=" not in attributes and "hidden" not in attributes:
        return ()
    found = set()
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        value = a or b or c
        name = name.lower()
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            for chunk in value.split():
                parts = [p.lower() for p in _TOKEN.findall(chunk)]
                for word in [*parts, "".join(parts)]:
                    family = _family(word)
                    if family is not None:
                        found.add(family)
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (
                name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            found.add("hidden")
    return tuple(sorted(found))


@lru_cache(maxsize=None)
def _raw_end(tag: str) -> re.Pattern:
    """The end of a raw element; one pattern for each of ``RAW_TEXT``."""
    return re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I)


class Block:
    """A leaf block: its text, ancestors as (tag, families), linked characters."""

    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple, linked: int):
        self.text, self.path, self.linked = text, path, linked


def leaf_blocks(page: str) -> list[Block]:
    """The page's leaf blocks in order; markup, scripts and comments are gone."""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, links = 0, 0
    unclosed: set[str] = set()  # raw elements that are not closed any more

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                blocks.append(Block(text, tuple(stack), linked))
            parts.clear()
        linked = 0

    def say(piece: str) -> None:
        nonlocal linked
        if piece:
            parts.append(piece)
            if links:
                linked += len(piece)

    at, n = 0, len(page)
    while at < n:
        m = _MARKUP.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        close = m[1]
        if close is not None:
            tag = close.lower()
            if tag == "a":
                links = max(0, links - 1)
            elif tag == "p" and not any(t == "p" for t, _ in stack):
                flush()
            elif tag not in INLINE and tag not in VOID:
                flush()
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
                if depth is not None:
                    del stack[depth:]
                    links = 0
            continue
        tag = m[2] or m[4]
        if tag is None:
            continue
        tag, attributes = tag.lower(), (m[3] if m[2] else m[5]) or ""
        if tag in RAW_TEXT:
            if not attributes.rstrip().endswith("/"):
                end = None if tag in unclosed else _raw_end(tag).search(page, at)
                if end is None:
                    unclosed.add(tag)
                at = end.end() if end else n if tag in TO_THE_END else at
            continue
        if tag == "a":
            links = 1
            continue
        if tag == "br" or tag == "hr":
            say(" ")
            if tag == "hr":
                flush()
            continue
        if tag in INLINE or tag in VOID:
            continue
        flush()
        links = 0
        if stack and stack[-1][0] == "p":
            stack.pop()  # a paragraph ends where the next block begins
        ends = IMPLIED_END.get(tag)
        while ends and stack and stack[-1][0] in ends:
            stack.pop()
        stack.append((tag, _families(attributes)))
    flush()
    return blocks


@lru_cache(maxsize=50_000)
def _path_features(path: tuple) -> tuple[str, ...]:
    """Features of a block's ancestors."""
    out = set()
    tags = [t for t, _ in path]
    out.add("in=" + next((t for t in reversed(tags) if t in _BLOCKS), "none"))
    for t in _TAGS:
        if t in tags:
            out.add("tag=" + t)
    families = {f for _, fs in path for f in fs}
    out.update("family=" + f for f in families)
    for i, t in enumerate(tags):
        if t in ("article", "main"):
            inner = {f for _, fs in path[i + 1:] for f in fs} | {t for t in tags[i + 1:]}
            out.add("inside=article")
            if not inner & _CLUTTER:
                out.add("inside=article only")
            out.update("inside+" + f for f in inner & {"comment", "ad", "share", "side", "notice", "form", "aside", "nav",
                                                       "footer", "header", "menu", "figure", "article"})
    if "header" in tags and not any(t in ("article", "main") for t in tags):
        out.add("page header")
    nearest = next((fs for _, fs in reversed(path) if fs), ())
    out.update("nearest=" + f for f in nearest)
    if not families and not any(t in _TAGS for t in tags):
        out.add("plain")
    return tuple(sorted(out))


def _bucket(n: int, limits: tuple[int, ...]) -> int:
    return sum(n >= x for x in limits)


def features(blocks: list[Block]) -> list[list[str]]:
    """Feature names of every block of one page."""
    out = []
    last = len(blocks) - 1
    for i, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        size = _bucket(words, (2, 4, 8, 15, 30, 60))
        dense = _bucket(int(100 * b.linked / max(1, len(b.text))), (1, 30, 70))
        row = [*_path_features(b.path), "bias", f"size={size}", f"links={dense}", f"both={size}/{dense}"]
        row.append("ends" if b.text[-1] in ".!?…\"”»" else "open")
        if "©" in b.text or re.match(r"(?i)copyright|all rights reserved", b.text):
            row.append("owner")
        if "|" in b.text or "»" in b.text or "›" in b.text:
            row.append("bars")
        if i < 2:
            row.append("first")
        if i > last - 2:
            row.append("last")
        out.append(row)
    return out


class PageModel:
    """Feature numbers and the trained chain."""

    def __init__(self, number: dict[str, int], chain: crf.Chain):
        self.number, self.chain = number, chain
        self.weight = dict(zip(number, chain.weights.tolist()))

    def labels(self, blocks: list[Block]) -> list[int]:
        get = self.weight.get
        return crf.viterbi(self.chain, np.array([sum(get(f, 0.0) for f in row) for row in features(blocks)]))

    def text(self, page: str | None) -> str:
        if not page:
            return ""
        blocks = leaf_blocks(page)
        return " ".join(b.text for b, keep in zip(blocks, self.labels(blocks)) if keep)


def train(pages: Iterable[tuple[str, Callable[[str], int]]]) -> PageModel:
    """Fit the chain on labelled pages: (html, label of a block's text)."""
    number: dict[str, int] = {}
    ids, counts, labels, lengths = [], [], [], []
    for page, label in pages:
        blocks = leaf_blocks(page)
        lengths.append(len(blocks))
        for b, row in zip(blocks, features(blocks)):
            ids += [number.setdefault(f, len(number)) for f in row]
            counts.append(len(row))
            labels.append(label(b.text))
    chain = crf.fit(np.array(ids, np.int64), np.array(counts, np.int64), np.array(labels, np.int64), np.array(lengths),
                    len(number), rounds=300, l2=0.1)
    return PageModel(number, chain)


# ---------------------------------------------------------------------------
# Labelled training pages. Every text is made of invented words; texts of the
# article carry the word "zmain", which no feature sees, as their label.
# ---------------------------------------------------------------------------
MARK = "zmain"


def _prose(rng: random.Random, low: int, high: int, main: bool, stop: bool = True) -> str:
    words = ["".join(rng.choice(["ka", "lo", "mi", "ter", "an", "os", "re", "du"]) for _ in range(rng.randint(1, 3)))
             for _ in range(rng.randint(low, high))]
    if main:
        words[rng.randrange(len(words))] = MARK
    text = " ".join(words).capitalize() if not main or words[0] != MARK else " ".join(words)
    for _ in range(len(words) // 12):
        text = text.replace(" ", ", ", 1) if rng.random() < 0.2 else text
    return text + (rng.choice([".", ".", "!", "?"]) if stop else "")


def _page(rng: random.Random) -> str:
    def p(main: bool, low: int = 4, high: int = 90) -> str:
        body = _prose(rng, low, high, main, rng.random() < 0.93)
        if rng.random() < 0.25:
            body = f'{body} <a href="/x">{_prose(rng, 1, 3, False, False)}</a>'
        if rng.random() < 0.1:
            body = f"<b>{body}"
        return f"<p>{body}" + ("</p>" if rng.random() < 0.85 else "")

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{k}">{_prose(rng, 1, 4, False, rng.random() < .2)}</a></li>' for k in range(n)) + "</ul>"

    def box(tag: str, name: str, inner: str) -> str:
        attribute = rng.choice(["class", "class", "id"])
        return f'<{tag} {attribute}="{name}">{inner}</{tag}>' if name else f"<{tag}>{inner}</{tag}>"

    def pick(family: str) -> str:
        names = FAMILIES[family].split()
        return rng.choice(names) + rng.choice(["", "", "-box", "-1", "_wrap", " block", "-area"])

    def some(low: int = 3, high: int = 40) -> str:
        body = "".join(p(False, low, high) for _ in range(rng.randint(1, 3)))
        return rng.choice([body, _prose(rng, low, high, False), f"<div>{_prose(rng, low, high, False)}</div>"])

    def clutter() -> str:
        kind = rng.choice(["ad", "side", "notice", "share", "form", "comment", "menu"])
        if kind == "form":
            return rng.choice([f"<form>{_prose(rng, 1, 8, False, False)}<input><button>{_prose(rng, 1, 2, False, False)}</button></form>",
                               box("form", pick("form"), f"<label>{_prose(rng, 2, 12, False)}</label><p>{_prose(rng, 3, 30, False)}</p>")])
        if kind == "menu":
            return rng.choice([f"<nav>{links(rng.randint(3, 8))}</nav>", box("div", pick("menu"), links(rng.randint(3, 8)))])
        if kind == "side":
            return rng.choice([f"<aside>{some()}{links(3)}</aside>", box("div", pick("side"), some() + links(rng.randint(1, 5))),
                               f"<aside>{some(5, 60)}</aside>"])
        if kind == "comment":
            return comments()
        return box(rng.choice(["div", "div", "section", "p" if kind in ("ad", "notice") else "div"]), pick(kind),
                   _prose(rng, 2, 60, False) if rng.random() < 0.6 else some(2, 60))

    def comments() -> str:
        name = rng.choice(["comment", "comments", "reply", "discussion", "responses", "comment-list", "user-comments", "disqus_thread"])
        one = lambda: rng.choice([
            box("div", "comment", f"<h4>{_prose(rng, 1, 2, False, False)}</h4>{p(False, 3, 80)}"),
            f"<article class='comment'>{p(False, 3, 80)}</article>", f"<li>{_prose(rng, 3, 80, False)}</li>", p(False, 3, 80)])
        head = f"<h3>{_prose(rng, 1, 3, False, False)}</h3>" if rng.random() < 0.6 else ""
        return box(rng.choice(["div", "section", "ul", "ol"]), name, head + "".join(one() for _ in range(rng.randint(1, 6))))

    def body() -> str:
        out = [f"<{h}>{_prose(rng, 2, 14, True, rng.random() < .4)}</{h}>" for h in ["h1"] if rng.random() < 0.8]
        if rng.random() < 0.2:
            out = [f"<header>{''.join(out)}{p(True, 3, 15)}</header>"] if out else out
        if rng.random() < 0.2:
            out.append(box("div", rng.choice(["byline", "meta", "share", "post-meta", "social"]), _prose(rng, 1, 6, False, False)))
        for _ in range(rng.choice([1, 1, 2, 3, 5, 9, 16])):
            r = rng.random()
            if r < 0.72:
                out.append(p(True, rng.choice([1, 2, 4, 10, 30]), 120))
            elif r < 0.8:
                out.append(f"<h2>{_prose(rng, 1, 9, True, False)}</h2>")
            elif r < 0.86:
                tag = rng.choice(["ul", "ol"])
                out.append(f"<{tag}>" + "".join(f"<li>{_prose(rng, 2, 25, True, rng.random() < .5)}</li>" for _ in range(rng.randint(2, 5))) + f"</{tag}>")
            elif r < 0.9:
                out.append(f"<blockquote>{_prose(rng, 5, 40, True)}</blockquote>")
            elif r < 0.92:
                out.append("<table><tr><td>" + _prose(rng, 1, 6, True, False) + "</td><td>" + _prose(rng, 1, 6, True, False) + "</td></tr></table>")
            elif r < 0.94:
                out.append(f"<figure><img src='x'><figcaption>{_prose(rng, 3, 15, True)}</figcaption></figure>")
            elif r < 0.96:
                out.append(f"<div>{_prose(rng, 4, 60, True)}</div>")
            else:
                out.append(clutter())
        return "".join(out)

    level = rng.choice(["h1", "h1", "h2", "p", "div"])
    top = [f"<header>{_prose(rng, 1, 8, False, False)}</header>",
           f"<header><{level}>{_prose(rng, 1, 6, False, False)}</{level}>{rng.choice(['', f'<nav>{links(4)}</nav>', p(False, 2, 12)])}</header>",
           box("div", pick("header"), f"<{level}>{_prose(rng, 1, 6, False, False)}</{level}>"), f"<nav>{links(rng.randint(3, 9))}</nav>",
           box("div", pick("header"), _prose(rng, 1, 10, False, False)), box("div", pick("menu"), links(rng.randint(3, 9))),
           box("div", pick("notice"), some(4, 50)), box("div", pick("ad"), _prose(rng, 2, 40, False)),
           f"<form>{_prose(rng, 1, 5, False, False)}</form>", "<header><nav>" + links(4) + "</nav></header>", clutter()]
    rng.shuffle(top)
    main = rng.choice(["article", "article", "article", "main", "main-article", "content", "plain", "section"])
    inner = body()
    if main == "article":
        inner = f"<article>{inner}</article>"
    elif main == "main":
        inner = f"<main>{inner}</main>"
    elif main == "main-article":
        inner = f"<main><article class='{rng.choice(['post', 'entry', 'story', ''])}'>{inner}</article>{clutter() if rng.random() < .4 else ''}</main>"
    elif main == "content":
        inner = box("div", rng.choice(FAMILIES["main"].split()), inner)
    elif main == "section":
        inner = f"<section>{inner}</section>"
    else:
        inner = f"<div>{inner}</div>"
    bottom = [clutter() for _ in range(rng.randint(0, 3))]
    if rng.random() < 0.4:
        bottom.append(comments())
    rng.shuffle(bottom)
    owner = rng.choice(["&copy; ", "Copyright ", "", "&copy; 2024 "])
    bottom.append(rng.choice([f"<footer>{owner}{_prose(rng, 2, 40, False)}</footer>", f"<footer><p>{owner}{_prose(rng, 2, 40, False)}</p>{links(3)}</footer>",
                              box("div", pick("footer"), owner + _prose(rng, 2, 30, False)), ""]))
    if rng.random() < 0.25:
        top.append(box("div", pick("side"), some() + links(3)))
    end = rng.choice(["</body></html>", "</body></html>", ""])
    return (f"<!DOCTYPE html><html><head><title>{_prose(rng, 2, 9, False)}</title><script>var a='<p>';</script></head><body>"
            + "".join(top[: rng.randint(0, 4)]) + inner + "".join(bottom) + end)


def labelled_pages(count: int = TRAINING_PAGES, seed: int = SEED) -> list[tuple[str, Callable[[str], int]]]:
    """``count`` composed pages, each with the label of its blocks."""
    rng = random.Random(seed)
    return [(_page(rng), lambda text: int(MARK in text.lower())) for _ in range(count)]


@lru_cache(maxsize=1)
def default_model() -> PageModel:
    return train(labelled_pages())


def extract(pages: DataFrame, html_column: str = "html", out: str = "text", model: PageModel | None = None) -> DataFrame:
    """``pages`` without the html column but with its main text as a last column,
    ``out`` or, if there is one of that name, the next one unused."""
    need(pages, [html_column])
    model = model or default_model()
    kept = [c for c in pages.columns if c != html_column]
    [out] = unused(pages.select(*kept), out)
    rows = pages.select(*kept, html_column)
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField(out, T.StringType(), False)])

    def batches(it):
        for batch in it:
            for a in range(0, len(batch), 500):
                part = batch.slice(a, 500)
                texts = [model.text(p) for p in part.column(len(kept)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(batches, schema)
