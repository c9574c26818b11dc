"""Main text of web pages: a linear-chain CRF over the DOM's leaf blocks.

A page becomes its blocks of text in order, each with the tags above it. Every
block gives features of its ancestors (tags, and the words of their class, id
and role) and of its text (length, links, punctuation, place). A conditional
random field with two states, main text or not, scores them; Viterbi picks the
best sequence. It is trained here, on ``labelled_pages``: invented pages whose
blocks carry their label, over many layouts, in a bounded number.

Scripts, styles, comments and other parts that are never shown hold no block.
Null or empty html gives the empty text; broken markup is read as far as it
goes; text outside any tag is a block. A head ends at </head>, or at the first tag or
text that cannot stand in one. Repeated rows get equal results.
"""

from __future__ import annotations

import html as html_lib
import math
import random
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import read
from quarry.llm.registry import query

TRAINING_PAGES = 500
# A quote opens a value only after "="; elsewhere it belongs to a name. A quote that never closes is an ordinary character.
TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s>]++)?)?)*+)(?:>|\Z)""",
    re.S | re.X,
)
ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|aria-label|hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
HIDDEN = frozenset("script style noscript template svg canvas iframe object head title select option textarea button annotation annotation-xml audio video map".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template html".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"body", "html"}
NAME = re.compile(r"[a-z]+")
SPLIT_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Block:
    """``tags`` and ``names``: all tags above the block and the words of their
    attributes; ``last`` the innermost tag, ``own`` the innermost block tag."""

    __slots__ = ("tags", "names", "last", "own", "text", "linked")

    def __init__(self, tags, names, last, own, text, linked):
        self.tags, self.names, self.last, self.own, self.text, self.linked = tags, names, last, own, text, linked


class Open:
    """An open element: its own tag and words, and what holds for it and all elements above it.

    Sets are shared with the element above wherever nothing new joins them, so
    a page of any depth costs what its tags cost."""

    __slots__ = ("tag", "own_names", "tags", "names", "block")

    def __init__(self, tag, own_names, above):
        tags, names = (above.tags, above.names) if above else (frozenset(), frozenset())
        self.tag, self.own_names = tag, own_names
        self.tags = tags if tag in tags else tags | {tag}
        self.names = names if own_names <= names else names | own_names
        self.block = tag if tag in BLOCKS else above.block if above else None


def _names(attrs: str) -> frozenset:
    words = set()
    for m in ATTRIBUTE.finditer(attrs):
        value = (m[2] or m[1]).strip("\"'")
        words.update(NAME.findall(SPLIT_CAMEL.sub(" ", value).lower()))
    return frozenset(words)


def blocks_of(page: str | None) -> list[Block]:
    """The page's leaf blocks in order: text between block boundaries, white space collapsed."""
    if not page:
        return []
    out, stack, text, linked = [], [], [], 0
    at, n, hidden = 0, len(page), 0
    is_open: Counter = Counter()

    def end_block():
        nonlocal linked
        if text:
            s = " ".join("".join(text).split())
            if s:
                share = min(1.0, linked / max(1, len(s)))
                top = stack[-1] if stack else None
                out.append(Block(top.tags, top.names, top.tag, top.block or "none", s, share) if top else Block(frozenset(), frozenset(), None, "none", s, share))
            text.clear()
        linked = 0

    def add(s):
        nonlocal linked
        if hidden and stack[-1].tag == "head" and s.strip():
            end_head()
        if s and not hidden:
            s = html_lib.unescape(s)
            text.append(s)
            if is_open["a"]:
                linked += len(s.strip())

    def pop_to(i):
        nonlocal hidden
        for e in stack[i:]:
            hidden -= e.tag in HIDDEN
            is_open[e.tag] -= 1
        del stack[i:]

    def end_head():
        """Markup may leave </head> out: what cannot stand in a head ends it."""
        if is_open["head"]:
            pop_to(next(i for i, e in enumerate(stack) if e.tag == "head"))

    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m[2] is None:  # comment, doctype
            continue
        tag, attrs = m[2].lower(), m[3]
        if tag not in IN_HEAD and tag != "head" and (not m[1] or tag in ("body", "br")):
            end_head()
        if m[1]:
            i = next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag) if is_open[tag] else None
            if tag in BLOCKS:
                end_block()
            if i is not None:
                # an inline end tag never closes a block that is open inside it
                if tag in BLOCKS or tag in HIDDEN or not any(e.tag in BLOCKS for e in stack[i + 1 :]):
                    pop_to(i)
                else:
                    inner = stack[i + 1 :]
                    is_open[tag] -= 1
                    del stack[i:]
                    for e in inner:
                        stack.append(Open(e.tag, e.own_names, stack[-1] if stack else None))
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCKS:
            end_block()
            near = stack[-1].block if stack else None
            if (near == "p" and tag in CLOSES_P) or (near == tag and tag in ("li", "td", "th", "tr", "dd", "dt")):
                pop_to(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == near))
        if tag in VOID or attrs.endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:  # its content is not markup
            e = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = e.end() if e else n
            continue
        stack.append(Open(tag, _names(attrs), stack[-1] if stack else None))
        is_open[tag] += 1
        hidden += tag in HIDDEN
    end_block()
    return out


def features(blocks: list[Block]) -> list[list[str]]:
    out, n = [], len(blocks)
    headings = [i for i, b in enumerate(blocks) if b.last in ("h1", "h2")]
    for i, b in enumerate(blocks):
        f = ["bias"]
        f += [f"in:{t}" for t in sorted(b.tags)]
        f += [f"name:{w}" for w in sorted(b.names)]
        words = b.text.split()
        size = min(6, int(math.log2(len(words) + 1)))
        f += [f"own:{b.own}", f"size:{size}", f"link:{int(b.linked * 4)}", f"own:{b.own}:{size}"]
        last = b.text.rstrip("\"')”»*%#$& ")[-1:]
        f.append(f"end:{'stop' if last in '.!?' and last else 'none'}:{min(size, 4)}")
        f.append(f"commas:{min(3, b.text.count(','))}")
        if "©" in b.text or "copyright" in b.text.lower():
            f.append("copyright")
        f.append(f"place:{i * 5 // n}")
        if headings:
            f.append("after:heading" if i >= headings[0] else "before:heading")
        out.append(f)
    return out


# ---- labelled pages -------------------------------------------------------

SYLLABLES = "ta re mi no sel ver than ing ou la che de en tion er st ä é ñ ar lo ki wo za bre".split()


def _sentence(r: random.Random, lo: int, hi: int) -> str:
    w = ["".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(lo, hi))]
    for i in range(len(w) - 1):
        if r.random() < 0.08:
            w[i] += ","
    return " ".join(w).capitalize() + "."


def _paragraph(r: random.Random) -> str:
    s = " ".join(_sentence(r, 2, 16) for _ in range(r.randint(1, r.choice((1, 2, 6)))))
    if r.random() < 0.1:
        s = " ".join(w + r.choice(("%%%", "***", "&&&", "###")) for w in s.split())
    return s


def _words(r: random.Random, lo: int, hi: int) -> str:
    return _sentence(r, lo, hi).rstrip(".")


def labelled_pages(n: int = TRAINING_PAGES, seed: int = 7) -> list[tuple[list[Block], list[int]]]:
    """Invented pages as (blocks, labels): layouts, container names and texts vary."""
    r, out = random.Random(seed), []
    for _ in range(n):
        parts: list[tuple[str, bool]] = []  # html of a block or container edge, main or not

        def junk(kind, r=r):
            sentence = r.random() < 0.5
            inner = {
                "menu": lambda: "<ul>" + "".join(f'<li><a href="/x">{_words(r, 1, 3)}</a></li>' for _ in range(r.randint(2, 8))) + "</ul>",
                "ad": lambda: (_sentence(r, 3, 14) if sentence else f'<a href="/ad">{_words(r, 2, 8)}</a>'),
                "footer": lambda: r.choice((f"&copy; {_words(r, 1, 3)} &middot; {_sentence(r, 2, 10)}", f"<p>{_sentence(r, 3, 12)}</p><p>&copy; 2024 {_words(r, 1, 3)}</p>", "<a href='/a'>" + _words(r, 1, 2) + "</a> | <a href='/b'>" + _words(r, 1, 2) + "</a>")),
                "header": lambda: r.choice((f"<h1>{_words(r, 1, 3)}</h1>", f"<a href='/'>{_words(r, 1, 3)}</a><p>{_words(r, 2, 8)}</p>", _words(r, 1, 6))),
                "side": lambda: f"<h3>{_words(r, 1, 3)}</h3>" + "".join(f"<p>{_sentence(r, 3, 25)}</p>" if sentence else f"<li><a href='/y'>{_words(r, 2, 8)}</a></li>" for _ in range(r.randint(1, 5))),
                "notice": lambda: f"<p>{_sentence(r, 5, 25)}</p>" + r.choice(("", f"<a href='/ok'>{_words(r, 1, 2)}</a>")),
                "form": lambda: f"<label>{_words(r, 1, 4)}</label><input name=a><p>{_sentence(r, 3, 12)}</p>",
                "comments": lambda: f"<h3>{_words(r, 1, 2)}</h3>" + "".join(f"<div class={r.choice(('comment', 'reply', 'c'))}><b>{_words(r, 1, 2)}</b><p>{_paragraph(r)}</p></div>" for _ in range(r.randint(1, 5))),
            }[kind]()
            tag, names = {
                "menu": (("nav", "div", "ul"), ("nav", "menu", "navbar", "breadcrumb", "topnav", "main-menu", "pagination", "toc")),
                "ad": (("div", "aside", "section", "p"), ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "banner", "ad-slot", "adbox")),
                "footer": (("footer", "div"), ("footer", "site-footer", "page-footer", "copyright", "foot")),
                "header": (("header", "div"), ("header", "site-header", "masthead", "topbar", "logo", "banner")),
                "side": (("aside", "div", "section"), ("sidebar", "side", "related", "widget", "popular", "recommended", "trending", "rail")),
                "notice": (("div", "section", "p", "aside"), ("cookie", "cookie-notice", "consent", "notice", "gdpr", "alert", "newsletter", "subscribe", "popup", "modal", "paywall")),
                "form": (("form", "div"), ("form", "search", "login", "signup", "newsletter-form", "contact-form")),
                "comments": (("section", "div", "ol"), ("comments", "comment-list", "discussion", "replies", "respond", "disqus")),
            }[kind]
            t = tag[0] if r.random() < 0.5 else r.choice(tag)
            plain = t not in ("div", "section", "p", "ul", "ol") and r.random() < 0.6
            attr = "" if plain else f' {r.choice(("class", "class", "id"))}="{r.choice(names)}"'
            return f"<{t}{attr}>{inner}</{t}>"

        before = [k for k in ("header", "menu", "notice", "ad", "form", "side") if r.random() < 0.45]
        after = [k for k in ("ad", "side", "comments", "form", "menu", "notice", "footer") if r.random() < 0.5]
        r.shuffle(before)
        for k in before:
            parts.append((junk(k), False))
        shape = r.random()
        box, attr = ("article", "") if shape < 0.4 else ("main", "") if shape < 0.5 else ("div", f' class="{r.choice(("content", "post", "post-body", "entry-content", "article-body", "story", "text", "main-content", "body-text"))}"') if shape < 0.85 else ("div", "")
        parts.append((f"<{box}{attr}>", None))
        if r.random() < 0.8:
            parts.append((f"<h1>{_words(r, 3, 10)}</h1>", True))
        if r.random() < 0.2:
            parts.append((junk(r.choice(("ad", "notice"))), False))
        for _ in range(r.randint(1, 9)):
            kind = r.random()
            if kind < 0.75:
                parts.append((f"<p>{_paragraph(r)}" + ("</p>" if r.random() < 0.9 else "<br>"), True))
            elif kind < 0.8:
                parts.append((f"<{(h := r.choice(('h2', 'h3')))}>{_words(r, 2, 8)}</{h}>", True))
            elif kind < 0.85:
                parts.append(("<ul>" + "".join(f"<li>{_sentence(r, 2, 14)}</li>" for _ in range(r.randint(2, 5))) + "</ul>", True))
            elif kind < 0.88:
                parts.append((f"<blockquote>{_paragraph(r)}</blockquote>", True))
            elif kind < 0.91:
                parts.append((f"<pre>{_words(r, 3, 20)}</pre>", True))
            elif kind < 0.94:
                parts.append((f"<table><tr><td>{_words(r, 1, 4)}</td><td>{_words(r, 1, 4)}</td></tr></table>", True))
            else:
                parts.append((junk(r.choice(("ad", "side", "notice", "form"))), False))
        parts.append((f"</{box}>", None))
        for k in after:
            parts.append((junk(k), False))
        page, labels, seen = "", [], 0
        for piece, main in parts:
            page += piece
            now = len(blocks_of(page + "<hr>"))
            labels += [int(bool(main))] * (now - seen)
            seen = now
        got = blocks_of(f"<html><body>{page}</body></html>")
        if len(got) == len(labels) and got:
            out.append((got, labels))
    return out


# ---- the chain ------------------------------------------------------------


class Chain:
    """Two-state linear-chain CRF: state weights per feature, and a 2x2 of transitions."""

    def __init__(self, weights: dict[str, float], trans: np.ndarray):
        self.weights, self.trans = weights, trans

    def scores(self, feats: list[list[str]]) -> np.ndarray:
        w = self.weights
        s = np.zeros((len(feats), 2))
        s[:, 1] = [sum(w.get(f, 0.0) for f in fs) for fs in feats]
        return s

    def decode(self, feats: list[list[str]]) -> list[int]:
        """Viterbi; ties keep the block out."""
        a = self.scores(feats)[:, 1].tolist()
        (t00, t01), (t10, t11) = self.trans.tolist()
        v0, v1, back = 0.0, a[0], []
        for x in a[1:]:
            b0, b1 = int(v1 + t10 > v0 + t00), int(v1 + t11 > v0 + t01)
            back.append((b0, b1))
            v0, v1 = (v1 + t10 if b0 else v0 + t00), (v1 + t11 if b1 else v0 + t01) + x
        y = [int(v1 > v0)]
        for b in reversed(back):
            y.append(b[y[-1]])
        return y[::-1]


def train(pages, epochs: int = 12, rate: float = 0.3, decay: float = 1e-4) -> Chain:
    """Log-likelihood by AdaGrad, one page a step, forward-backward for the expectations."""
    feats = [features(b) for b, _ in pages]
    names = sorted({f for p in feats for fs in p for f in fs})
    ids = {f: i for i, f in enumerate(names)}
    data = [([np.array([ids[f] for f in fs]) for fs in p], np.array(y)) for p, (_, y) in zip(feats, pages)]
    w, t = np.zeros(len(names)), np.zeros((2, 2))
    gw, gt = np.full(len(names), 1e-6), np.full((2, 2), 1e-6)
    order = random.Random(1)
    for _ in range(epochs):
        order.shuffle(data)
        for rows, y in data:
            n = len(rows)
            s = np.zeros((n, 2))
            s[:, 1] = [w[r].sum() for r in rows]
            fwd, bwd = np.zeros((n, 2)), np.zeros((n, 2))
            fwd[0] = s[0]
            for i in range(1, n):
                fwd[i] = s[i] + np.logaddexp(fwd[i - 1, 0] + t[0], fwd[i - 1, 1] + t[1])
            for i in range(n - 2, -1, -1):
                bwd[i] = np.logaddexp(t[:, 0] + s[i + 1, 0] + bwd[i + 1, 0], t[:, 1] + s[i + 1, 1] + bwd[i + 1, 1])
            z = np.logaddexp(*fwd[-1])
            p1 = np.exp(fwd[:, 1] + bwd[:, 1] - z)
            step = np.zeros(len(names))
            for i, r in enumerate(rows):
                step[r] += y[i] - p1[i]
            step -= decay * w
            gt_step = np.zeros((2, 2))
            if n > 1:
                both = fwd[:-1, :, None] + t[None] + (s[1:] + bwd[1:])[:, None, :] - z
                gt_step -= np.exp(both).sum(0)
                np.add.at(gt_step, (y[:-1], y[1:]), 1.0)
            gw += step**2
            gt += gt_step**2
            w += rate * step / np.sqrt(gw)
            t += rate * gt_step / np.sqrt(gt)
    return Chain({f: float(w[i]) for f, i in ids.items() if abs(w[i]) > 1e-9}, t)


@lru_cache(maxsize=2)
def default_chain(n_pages: int = TRAINING_PAGES) -> Chain:
    return train(labelled_pages(n_pages))


def main_text(page: str | None, chain: Chain) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    return "\n".join(b.text for b, y in zip(blocks, chain.decode(features(blocks))) if y)


def extract(pages: DataFrame, chain: Chain | None = None, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text added."""
    shared = pages.sparkSession.sparkContext.broadcast(chain or default_chain())

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda p: main_text(p, shared.value))

    return pages.withColumn(out, run(F.coalesce(F.col(html), F.lit(""))))


@query("op9_html_extraction")
def op9_html_extraction(spark, d):
    """Main text of every page."""
    p = extract(read(spark, d, "pages").select("page_id", "url", "html"))
    return p.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
