"""Main-text extraction: a linear-chain conditional random field over DOM leaf blocks.

A page becomes the sequence of its leaf blocks (runs of text that no block element
interrupts) with features of their ancestor tags, class and id words, and text.  The
field has two labels, main text and the rest; its weights are trained by gradient ascent
on labelled pages, and Viterbi finds the best labels of a page.  The labelled pages are
laid out by ``labelled_pages`` from a seed: many site layouts whose parts are known, with
invented words.

A share of them has no marks at all: there the texts around a block tell the article from
the rest, so such context counts only for blocks that no tag or class marks.

Edge cases: null or empty html gives an empty text; unclosed and misnested tags close
where a browser closes them, buttons, selects and drawings included; an unfinished CDATA
section runs to the end; a cut-off tag at the end of a page is dropped; a cut-off
character reference stays as it is; repeated pages give the same text; further columns
of the input are not read.
"""

from __future__ import annotations

import html as entities
import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veridq.llm.common import arrow_map

TRAIN_PAGES = 600
PLAIN = 0.35
SEED = 7

BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table "
    "tbody td tfoot th thead title tr ul caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page.
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "title")
#: Elements like others, whose content is no text either: they also end where their parent
#: ends, and where another button or select begins.
CONTROLS = frozenset(("svg", "button", "select"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that say what their text is.
MARKS = frozenset("article main aside nav header footer form section figure dialog menu".split())
#: An opening tag closes these open elements, up to the nearest of the others.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

#: A quote opens a value only directly after "="; elsewhere, or without an end, it is a plain character.
ATTR = r"""[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+(?:[ \t\n\f\r]*+=[ \t\n\f\r]*+(?:"[^"]*+"|'[^']*+'|[^ \t\n\f\r>]*+))?+"""
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^ \t\n\f\r/>]*+(?:[ \t\n\f\r/]|" + ATTR + r")*+(?:>|\Z)", re.S)
UNQUOTED_SLASH = re.compile(r"""=[ \t\n\f\r]*(?:[^ \t\n\f\r"'>][^ \t\n\f\r>]*)?/>\Z""")
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRS = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
END_OF = {t: re.compile(rf"</{t}\s*>|</{t}\Z", re.I) for t in RAW}


class Block:
    """A leaf block: its text, ancestors and the characters of it inside links."""

    __slots__ = ("links", "path", "text", "words")

    def __init__(self, text: str, path: tuple[str, ...], words: tuple[str, ...], links: int):
        self.text, self.path, self.words, self.links = text, path, words, links


def closed(tag: str) -> bool:
    """Whether a tag ends with a slash that is not part of an unquoted value."""
    return tag.endswith("/>") and UNQUOTED_SLASH.search(tag) is None


def control_end(page: str, pos: int, control: str, outer: list[str]) -> int:
    """Where the element ``control`` that begins at ``pos`` ends: behind its end tag, before
    the end tag of an element around it, or before the next one of its kind.  One that
    nothing ends has no content: its tag alone is skipped."""
    open_: list[str] = []
    for m in TOKEN.finditer(page, pos):
        tag = m.group()
        if tag.startswith(("<!", "<?")):
            continue
        name = NAME.match(tag).group(1).lower()
        if tag[1] == "/":
            if name == control and name not in open_:
                return m.end()
            if name in open_:
                del open_[len(open_) - 1 - open_[::-1].index(name) :]
            elif name in outer:
                return m.start()
        elif name == control and control != "svg":
            return m.start()
        elif name not in VOID and not closed(tag) and (name in BLOCK or name == control):
            open_.append(name)
    return pos


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, white space collapsed."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    run: list[str] = []
    linked = 0
    link = 0  # open links

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                out.append(Block(text, tuple(t for t, _ in stack), tuple(w for _, ws in stack for w in ws), min(linked, len(text))))
            run.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = entities.unescape(raw)
            run.append(text)
            if link:
                linked += len(" ".join(text.split()))

    pos, n = 0, len(page)
    while pos < n:
        m = TOKEN.search(page, pos)
        if m is None:
            add(page[pos:])
            break
        add(page[pos : m.start()])
        pos = m.end()
        tag = m.group()
        if tag.startswith(("<!", "<?")):
            if tag.startswith("<![CDATA["):
                add(tag[9:-3] if tag.endswith("]]>") else tag[9:])
            continue
        name = NAME.match(tag).group(1).lower()
        if tag[1] == "/":
            if name == "a" and link:
                link -= 1
            if name == "br":
                run.append(" ")
            elif name in BLOCK:
                flush()
                at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
                if at is not None:
                    del stack[at:]
            continue
        if name in END_OF:
            if name == "title":
                flush()
            end = END_OF[name].search(page, pos)
            pos = n if end is None else end.end()
            nxt = page.find(">", pos) if end is not None and not page[end.start() : end.end()].endswith(">") else -1
            pos = nxt + 1 if nxt >= 0 else pos
            continue
        if name in CONTROLS:
            if not closed(tag):
                pos = control_end(page, pos, name, [t for t, _ in stack])
            continue
        if name == "br":
            run.append(" ")
            continue
        if name == "a":
            link = 0 if closed(tag) else 1
        if name not in BLOCK:
            continue
        flush()
        if name in VOID:
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()
        elif name in CLOSES:
            shut, stop = CLOSES[name]
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in stop:
                    break
                if stack[i][0] in shut:
                    del stack[i:]
                    break
        words = tuple(p.lower() for _, v in ATTRS.findall(tag) for p in PARTS.findall(v)) if "=" in tag else ()
        if not closed(tag):
            stack.append((name, words))
    flush()
    return out


def kind_of(b: Block) -> str:
    """Links, prose, or a short, middling or long text that does not end like a sentence."""
    chars = len(b.text)
    if 2 * b.links > chars:
        return "links"
    if b.text[-1] in ".!?…:;\"”":
        return "prose" if chars >= 60 else "sentence"
    return "short" if chars < 30 else "middling" if chars < 120 else "long"


def features(page: list[Block]) -> list[list[str]]:
    """Names of the features that hold, for each block: of its ancestors and their marks, its
    text, and the texts around it."""
    out = []
    kinds = [kind_of(b) for b in page]
    full = [0, *np.cumsum([k in ("prose", "long") for k in kinds]).tolist()]
    for i, b in enumerate(page):
        f = ["bias"]
        f += {f"in:{t}" for t in b.path}
        f += {f"word:{w}" for w in b.words}
        near = b.path[-1] if b.path else "none"
        f.append(f"tag:{'h' if near in HEADINGS else near}")
        if len(b.path) > 1:
            f.append(f"over:{b.path[-2]}")
        chars = len(b.text)
        f.append(f"long:{min(7, chars.bit_length())}")
        f.append(f"linked:{round(4 * b.links / chars)}")
        f.append("stop" if b.text[-1] in ".!?…:;\"”" else "open")
        if b.text[0] in "©®" or "©" in b.text:
            f.append("copyright")
        if b.text[0].islower():
            f.append("small")
        if b.words or not MARKS.isdisjoint(b.path):
            out.append(f)
            continue
        # no mark: what the text is like and what is around it
        f.append(f"plain:{kinds[i]}")
        f.append(f"before:{kinds[i - 1] if i else 'none'}")
        f.append(f"after:{kinds[i + 1] if i + 1 < len(page) else 'none'}")
        f.append(f"around:{full[min(i + 4, len(page))] - full[max(i - 3, 0)]}")
        f.append(f"ahead:{min(full[-1] - full[i], 2)}")
        f.append(f"behind:{min(full[i], 2)}")
        out.append(f)
    return out


class Field:
    """Weights of the field and the best labels of a page."""

    def __init__(self, weights: dict[str, float], moves: np.ndarray):
        self.weights, self.moves = weights, moves.tolist()

    def labels(self, page: list[Block]) -> list[int]:
        """Viterbi; label 1 is main text.  Scores are of label 1 against label 0."""
        get, t = self.weights.get, self.moves
        back, a, b = [], 0.0, 0.0
        for i, f in enumerate(features(page)):
            s = sum(get(x, 0.0) for x in f)
            if i == 0:
                a, b = 0.0, s
                continue
            x = (a + t[0][0], b + t[1][0])
            y = (a + t[0][1], b + t[1][1])
            back.append((x[1] > x[0], y[1] > y[0]))
            a, b = max(x), max(y) + s
        if not page:
            return []
        out = [int(b > a)]
        for x, y in reversed(back):
            out.append(int(y if out[-1] else x))
        return out[::-1]

    def text(self, page: str | None) -> str:
        got = blocks(page or "")
        return "\n".join(b.text for b, y in zip(got, self.labels(got), strict=True) if y)


def fit(pages: list[tuple[list[Block], list[int]]], rounds: int = 150, rate: float = 0.15, decay: float = 1e-3) -> Field:
    """Maximum likelihood by Adam; forward-backward over all pages at once."""
    pages = [p for p in pages if p[0]]
    feats = [features(p) for p, _ in pages]
    names = sorted({x for page in feats for f in page for x in f})
    at = {x: i for i, x in enumerate(names)}
    k, most = len(pages), max(len(p) for p, _ in pages)
    rows = np.concatenate([np.full(len(f), r) for r, f in enumerate([f for page in feats for f in page])])
    cols = np.array([at[x] for page in feats for f in page for x in f])
    n = sum(len(p) for p, _ in pages)
    x = np.zeros((n, len(names)), dtype=np.float32)
    x[rows, cols] = 1
    where = np.array([(r, i) for r, (p, _) in enumerate(pages) for i in range(len(p))])
    y = np.array([v for _, ys in pages for v in ys])
    mask = np.zeros((k, most), dtype=bool)
    mask[where[:, 0], where[:, 1]] = True
    gold = np.zeros((k, most), dtype=int)
    gold[where[:, 0], where[:, 1]] = y
    w, t = np.zeros(len(names)), np.zeros((2, 2))
    pairs = mask[:, 1:]
    seen = np.array([[((gold[:, :-1] == a) & (gold[:, 1:] == b) & pairs).sum() for b in (0, 1)] for a in (0, 1)])
    state = [np.zeros_like(v) for v in (w, w, t, t)]
    for step in range(1, rounds + 1):
        s = np.zeros((k, most, 2))
        s[where[:, 0], where[:, 1], 1] = x @ w.astype(np.float32)
        alpha, beta = np.zeros_like(s), np.zeros_like(s)
        alpha[:, 0] = s[:, 0]
        for i in range(1, most):
            nxt = np.logaddexp(alpha[:, i - 1, :1] + t[0], alpha[:, i - 1, 1:] + t[1]) + s[:, i]
            alpha[:, i] = np.where(mask[:, i, None], nxt, alpha[:, i - 1])
        for i in range(most - 2, -1, -1):
            ahead = beta[:, i + 1] + s[:, i + 1]
            prev = np.logaddexp(ahead[:, :1] + t[:, 0], ahead[:, 1:] + t[:, 1])
            beta[:, i] = np.where(mask[:, i + 1, None], prev, beta[:, i + 1])
        z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        p1 = np.exp(alpha[..., 1] + beta[..., 1] - z[:, None])[where[:, 0], where[:, 1]]
        joint = alpha[:, :-1, :, None] + t + (s + beta)[:, 1:, None, :] - z[:, None, None, None]
        expect = (np.exp(joint) * pairs[:, :, None, None]).sum((0, 1))
        gw = x.T @ (y - p1).astype(np.float32) / k - decay * w
        gt = (seen - expect) / k - decay * t
        for v, g, m1, m2 in ((w, gw, state[0], state[1]), (t, gt, state[2], state[3])):
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            v += rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    return Field({a: float(b) for a, b in zip(names, w, strict=True)}, t)


class Site:
    """A random layout: parts with known labels, written as html with the labels of
    its blocks in order."""

    def __init__(self, rng: random.Random, plain: bool = False):
        self.rng, self.html, self.labels, self.plain = rng, [], [], plain
        self.vocabulary = ["".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(60)]

    def words(self, lo: int, hi: int, end: str = "") -> str:
        got = " ".join(self.rng.choice(self.vocabulary) for _ in range(self.rng.randint(lo, hi)))
        return (got[:1].upper() + got[1:] if self.rng.random() < 0.8 else got) + end

    def prose(self) -> str:
        return " ".join(self.words(1, 18, self.rng.choice(". . . . , ! ? ".split(" "))) for _ in range(self.rng.choice([1, 1, 2, 4, 8])))

    def put(self, tag: str, text: str, label: int) -> None:
        self.html.append(f"{tag}{text}")
        self.labels.append(label)

    def leaf(self, tag: str, text: str, label: int, closed: bool = True) -> None:
        name = tag.split(" ")[0]
        self.put(f"<{tag}>", text + (f"</{name}>" if closed else ""), label)

    def link_list(self, k: int) -> None:
        self.html.append("<ul>")
        for _ in range(k):
            self.leaf("li", f'<a href="/{self.words(1, 1)}">{self.words(1, 2)}</a>', 0)
        self.html.append("</ul>")

    def article_part(self, depth: int = 0) -> None:
        r, kind = self.rng, self.rng.random()
        if kind < 0.6:
            text = self.prose() if r.random() < 0.92 else self.words(1, 6)
            if r.random() < 0.2:
                text = f"{text} <a href='x'>{self.words(1, 3)}</a> {self.words(1, 9, '.')}"
            if r.random() < 0.1:
                text = f"<b>{self.words(1, 6)}</b><br>{text}"
            self.leaf("p", text, 1, r.random() < 0.9)
        elif kind < 0.7:
            self.leaf(r.choice(["h2", "h3", "h4"]), self.words(1, 7), 1)
        elif kind < 0.78:
            self.html.append("<ul>")
            for _ in range(r.randint(1, 5)):
                self.leaf("li", self.words(1, 15, r.choice(["", "."])), 1)
            self.html.append("</ul>")
        elif kind < 0.84:
            self.html.append("<blockquote>")
            self.leaf("p", self.prose(), 1)
            self.html.append("</blockquote>")
        elif kind < 0.88:
            self.leaf("pre", self.words(2, 20), 1)
        elif kind < 0.92:
            self.html.append("<table>")
            for _ in range(r.randint(1, 3)):
                self.html.append("<tr>")
                for _ in range(2):
                    self.leaf("td", self.words(1, 3), 1)
                self.html.append("</tr>")
            self.html.append("</table>")
        elif kind < 0.96 and depth == 0 or self.plain:
            self.html.append("<div>" if self.plain else r.choice(["<section>", "<div>", '<div class="section">']))
            name = self.html[-1][1:].split(" ")[0].rstrip(">")
            for _ in range(r.randint(1, 3)):
                self.article_part(1) if depth == 0 else self.leaf("p", self.prose(), 1)
            self.html.append(f"</{name}>")
        else:
            self.aside(inside=True)

    def chrome(self) -> None:
        """A part that is not main text and has no mark: only its texts tell."""
        r, kind = self.rng, self.rng.random()
        self.html.append("<div>")
        if kind < 0.5:
            self.link_list(r.randint(2, 8))
        elif kind < 0.75:
            self.put("", " | ".join(f'<a href="/{self.words(1, 1)}">{self.words(1, 2)}</a>' for _ in range(r.randint(2, 6))), 0)
        else:
            for _ in range(r.randint(1, 3)):
                self.leaf(r.choice(["p", "div", "span"][:2]), f'<a href="/x">{self.words(1, 5)}</a>' if r.random() < 0.6 else self.words(1, 3), 0)
        self.html.append("</div>")

    def aside(self, inside: bool = False) -> None:
        """A part that is not main text."""
        r = self.rng
        word = r.choice(
            "ad ads advert advertisement sponsor sponsored promo banner cookie consent notice popup modal newsletter subscribe signup "
            "sidebar widget related recommended share social toolbar breadcrumb breadcrumbs pagination pager menu navbar topbar copyright legal".split()
        )
        how = r.random()
        open_ = (
            f'<aside class="{word}">' if how < 0.2 else f"<aside>" if how < 0.3 else f'<div class="{word}{r.choice(["", "-box", " wide", "_1"])}">' if how < 0.8
            else f'<div id="{word}">' if how < 0.9 else f'<section class="{word}">'
        )
        name = open_[1:].split(" ")[0].rstrip(">")
        self.html.append(open_)
        kind = r.random()
        if kind < 0.35:
            self.put("", self.words(3, 20, r.choice(["", "."])), 0)
        elif kind < 0.65:
            if r.random() < 0.5:
                self.leaf(r.choice(["h3", "h4"]), self.words(1, 4), 0)
            self.link_list(r.randint(1, 6))
        else:
            for _ in range(r.randint(1, 3)):
                self.leaf("p", self.prose(), 0)
        self.html.append(f"</{name}>")

    def form(self) -> None:
        self.html.append(self.rng.choice(["<form>", '<form class="search">', '<form action="/login">']))
        for _ in range(self.rng.randint(1, 3)):
            self.leaf(self.rng.choice(["p", "div", "legend"]), f"<label>{self.words(1, 5)}</label><input name='x'>", 0)
        self.html.append("</form>")

    def comments(self) -> None:
        r = self.rng
        name = r.choice(["div", "section", "div"])
        self.html.append(f'<{name} {r.choice(["class", "id"])}="{r.choice(["comments", "comment-list", "responses", "replies", "discussion", "commentlist"])}">')
        if r.random() < 0.6:
            self.leaf("h3", self.words(1, 3), 0)
        for _ in range(r.randint(1, 5)):
            inner = r.choice(['<div class="comment">', '<article class="comment">', "<div>"])
            self.html.append(inner)
            if r.random() < 0.5:
                self.leaf(r.choice(["span", "div", "p"]) if inner == "<div>" else "div", self.words(1, 2), 0) if r.random() < 0.7 else None
            self.leaf("p", self.prose(), 0)
            self.html.append(f"</{inner[1:].split(' ')[0].rstrip('>')}>")
        self.html.append(f"</{name}>")

    def plain_page(self) -> tuple[str, list[int]]:
        """A page whose article has no tag or class of its own, nor has the rest."""
        r = self.rng
        self.html.append(f"<html><head><title>{self.words(2, 8)}</title></head><body>")
        if r.random() < 0.5:
            self.html.append(r.choice(["<nav>", "<div>", "<div>"]))
            name = self.html[-1][1:4]
            self.link_list(r.randint(2, 8))
            self.html.append(f"</{name}>")
        for _ in range(r.choice([0, 1, 2])):
            self.chrome()
        wrap = r.choice(["<div>", "<div><div>", "", "<center>"])
        self.html.append(wrap)
        if r.random() < 0.8:
            self.leaf(r.choice(["h1", "h1", "h2"]), self.words(1, 12), 1)
        for _ in range(r.choice([1, 2, 2, 3, 5, 8, 14])):
            self.article_part()
        self.html.append(wrap.replace("<", "</"))
        for _ in range(r.choice([0, 1, 2])):
            self.chrome()
        if r.random() < 0.7:
            name = r.choice(["footer", "div", "div"])
            self.html.append(f"<{name}>")
            self.put("", r.choice(["&copy; {}", "&copy; 2024 {}. {}", "{} | {}"]).format(self.words(1, 3), self.words(1, 4)), 0)
            self.html.append(f"</{name}>")
        return "".join(self.html), self.labels

    def page(self) -> tuple[str, list[int]]:
        r = self.rng
        if self.plain:
            return self.plain_page()
        self.html.append(f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{self.words(2, 8)}</title><style>p{{margin:0}}</style></head><body>")
        if r.random() < 0.5:
            self.html.append("<header>" if r.random() < 0.6 else f'<div {r.choice(["class", "id"])}="{r.choice(["header", "masthead", "site-header"])}">')
            name = self.html[-1][1:].split(" ")[0].rstrip(">")
            for _ in range(r.randint(1, 2)):
                self.leaf(r.choice(["p", "div", "h1", "h2"]), self.words(1, 8), 0)
            if r.random() < 0.4:
                self.html.append("<nav>")
                self.link_list(r.randint(2, 7))
                self.html.append("</nav>")
            self.html.append(f"</{name}>")
        if r.random() < 0.7:
            self.html.append("<nav>" if r.random() < 0.6 else '<div class="nav">')
            name = self.html[-1][1:4]
            self.link_list(r.randint(2, 8))
            self.html.append(f"</{name}>")
        for _ in range(r.choice([0, 1, 1, 2])):
            self.aside() if r.random() < 0.8 else self.form()
        wrap = r.choice(["<main>", '<div class="container">', '<div id="wrapper">', ""])
        self.html.append(wrap)
        body = r.choice(
            ["<article>"] * 4
            + ['<article class="post">', '<div class="content">', '<div class="article">', '<div id="content">', '<div class="post-body">', '<div class="entry-content">', '<section class="story">', '<div class="main">', '<div class="text">']
        )
        self.html.append(body)
        head = r.random()
        if head < 0.75:
            self.leaf("h1", self.words(1, 12, r.choice(["", "."])), 1)
        elif head < 0.85:
            self.html.append("<header>")
            self.leaf("h1", self.words(1, 12), 1)
            self.html.append("</header>")
        for _ in range(r.choice([0, 1, 1, 2, 3, 5, 8, 14])):
            self.article_part()
        if r.random() < 0.08:
            self.html.append("<footer>")
            self.leaf("p", self.words(2, 12), 0)
            self.html.append("</footer>")
        if r.random() < 0.1:
            self.form()
        if r.random() < 0.1:
            self.comments()
        self.html.append(f"</{body[1:].split(' ')[0].rstrip('>')}>")
        if r.random() < 0.35:
            self.comments()
        if wrap:
            self.html.append(f"</{wrap[1:].split(' ')[0].rstrip('>')}>")
        for _ in range(r.choice([0, 0, 1, 2])):
            self.aside() if r.random() < 0.8 else self.form()
        if r.random() < 0.85:
            name, text = r.choice(["footer", "footer", "div"]), r.choice(["&copy; {} &middot; {}", "&copy; {} {}", "{} | {}", "{} {}"])
            self.html.append("<footer>" if name == "footer" else f'<div {r.choice(["class", "id"])}="{r.choice(["footer", "site-footer", "bottom"])}">')
            if r.random() < 0.5:
                self.put("", text.format(self.words(1, 3), self.prose()), 0)
            else:
                self.leaf("p", text.format(self.words(1, 3), self.prose()), 0)
            self.html.append(f"</{name}>")
        self.html.append("</body></html>" if r.random() < 0.9 else "")
        return "".join(self.html), self.labels


def labelled_pages(n: int = TRAIN_PAGES, seed: int = SEED, plain: float = PLAIN) -> list[tuple[str, list[int]]]:
    """Pages and the labels of their leaf blocks; a share ``plain`` of them without marks."""
    rng = random.Random(seed)
    return [Site(rng, rng.random() < plain).page() for _ in range(n)]


@lru_cache(maxsize=2)
def trained(n: int = TRAIN_PAGES, seed: int = SEED) -> Field:
    pages = []
    for text, labels in labelled_pages(n, seed):
        got = blocks(text)
        if len(got) == len(labels):  # else a part came out empty
            pages.append((got, labels))
    return fit(pages)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    model = field or trained()

    def make():
        def fn(ids, urls, raw):
            texts = [model.text(h) for h in raw]
            return {"page_id": ids, "url": urls, "text": texts, "n_chars": [len(t) for t in texts]}

        return fn

    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return arrow_map(src, make, "page_id long, url string, text string, n_chars long", "page_id", "url", "html")
