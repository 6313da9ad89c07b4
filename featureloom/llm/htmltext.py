"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page is parsed into its block elements; inline elements belong to the block around them. Every
node gets features of its subtree (text, link and tag density), its attribute tokens, its depth and
its siblings. Boosted trees, trained here, give each node the log-odds that it holds main text.
Decoding keeps the set of nodes with the largest sum that is closed towards the root: nothing
below a dropped node is kept, and a container is kept if what it holds is worth it.

There are no labelled nodes. The fit takes a bounded sample of pages whose own markup tells the
article (``article`` or ``main``), as they are and rebuilt: the same texts in other layouts,
where content and boilerplate stand in elements with other names or none.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureloom.llm.shared import hash_share
from featureloom.llm.text import blocks

_OPENS = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_ENDS = re.compile(r">|=\s*([\"'])")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Element names by their role in HTML: fixed values.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
SKIP = set("script style textarea title head noscript template iframe svg canvas object audio video button select option datalist xmp noembed noframes".split())
IN_HEAD = set("base basefont bgsound link meta noscript script style template title".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = set("ul ol menu dl table tbody thead tfoot select".split())
KINDS = [["p"], ["h1", "h2", "h3", "h4", "h5", "h6"], ["li", "dt", "dd"], ["ul", "ol", "menu", "dl"], ["div", "center"], ["section"], ["article"], ["main"], ["nav"], ["header"], ["footer"], ["aside"], ["table", "tbody", "tr", "td", "th"], ["blockquote", "pre"], ["figure", "figcaption"], ["body", "html", "#root"]]
KIND = {t: k for k, ts in enumerate(KINDS) for t in ts}
# Attribute tokens that tell boilerplate and content apart: fixed values.
AGAINST = set("ad ads advert advertisement banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright disclaimer footer gdpr header links login masthead menu meta modal nav navbar navigation newsletter notice pager pagination popup promo promotion recommended related replies reply search share sharing sidebar signup social sponsor sponsored subscribe tags teaser toolbar topbar widget".split())
FOR = set("article articlebody body content copy entry main post story text".split())


@dataclass
class Page:
    tag: list[str]
    parent: list[int]
    attrs: list[str]
    blocks: list[tuple[int, str, int]]  # node, text, characters of links
    inputs: list[int]  # fields and buttons of each node


class _Tags:
    """Tags of a page one after the other, in time linear in the page.

    A quote opens a value only after ``=``; elsewhere it is a character of the tag. Where a value is never closed, tags
    end at the next ``>`` from there on, so no later tag searches the rest of the page again. A ``<`` without any ``>`` behind it is text.
    """

    def __init__(self, source: str):
        self.source = source
        self.loose = False

    def _end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag, or -1."""
        i = at
        while not self.loose:
            m = _ENDS.search(self.source, i)
            if m and not m[1]:
                return m.start()
            i = self.source.find(m[1], m.end()) + 1 if m else 0
            self.loose = i == 0
        return self.source.find(">", at)

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """``(start, end, closes, name, attributes)`` of the next tag; comments and declarations have no name."""
        m = _OPENS.search(self.source, at)
        if not m:
            return None
        if m[2]:
            end = self._end(m.end())
        else:
            mark = {"<!--": "-->", "<![CDATA[": "]]>"}.get(m[0], ">")
            end = self.source.find(mark, m.end())
            if end < 0 and mark != ">":
                return m.start(), len(self.source), False, "", ""
            end += len(mark) - 1 if end >= 0 else 0
        if end < 0:
            return None
        return m.start(), end + 1, m[1] == "/", (m[2] or "").lower(), self.source[m.end() : end] if m[2] else ""


class _Open:
    """Open elements. Counts by name tell in one step that an end tag or an implied end has nothing to close."""

    def __init__(self):
        self.stack = [("#root", 0)]  # names and the node each belongs to
        self.blocks = [0]  # depths of those that are not inline
        self.named = defaultdict(int)
        self.inline = [defaultdict(int)]  # inline elements since the last block
        self.held = [defaultdict(int)]  # all elements since the last one that holds items of its own

    def push(self, name: str, node: int) -> None:
        if name in INLINE:
            self.inline[-1][name] += 1
        else:
            self.blocks.append(len(self.stack))
            self.inline.append(defaultdict(int))
        if name in HOLDS:
            self.held.append(defaultdict(int))
        else:
            self.held[-1][name] += 1
        self.named[name] += 1
        self.stack.append((name, node))

    def pop(self) -> str:
        name, _ = self.stack.pop()
        self.named[name] -= 1
        if name in HOLDS:
            self.held.pop()
        else:
            self.held[-1][name] -= 1
        if name in INLINE:
            self.inline[-1][name] -= 1
        else:
            self.blocks.pop()
            self.inline.pop()
        return name

    def deepest(self, names: set[str]) -> int:
        """Depth of the innermost of ``names``; called only where one of them is open."""
        return next(d for d in range(len(self.stack) - 1, 0, -1) if self.stack[d][0] in names)

    def closed_by(self, name: str) -> int | None:
        """Depth of what the end tag ``name`` closes; an inline one closes nothing beyond the block around it."""
        count = self.inline[-1] if name in INLINE else self.named
        return self.deepest({name}) if count[name] else None

    def ended_by(self, name: str) -> int | None:
        """Depth of what the start tag ``name`` ends without an end tag: paragraphs and items of the same list."""
        if name in SAME:
            return self.deepest(SAME[name]) if any(self.held[-1][x] for x in SAME[name]) else None
        block = self.blocks[-1]
        return block if name in CLOSES_P and self.stack[block][0] == "p" else None


def parse(source: str) -> Page:
    """Block nodes (0 is the root) and blocks of text in page order; never fails, in time linear in the page."""
    page = Page(["#root"], [-1], [""], [], [0])
    tags, open_ = _Tags(source), _Open()
    stack = open_.stack
    skipping = links = 0
    pieces: list[str] = []
    linked = 0
    at, end = 0, len(source)

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                page.blocks.append((stack[-1][1], text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def close_to(depth: int | None) -> None:
        nonlocal skipping, links
        while depth is not None and len(stack) > depth:
            if stack[-1][0] not in INLINE:
                flush()
            name = open_.pop()
            skipping -= name in SKIP
            links -= name == "a"

    while at < end:
        tag = tags.after(at)
        text = source[at : tag[0] if tag else end]
        if stack[-1][0] == "head" and text.strip():
            close_to(len(stack) - 1)  # its end tag may be left out
        if text and not skipping:
            pieces.append(text)
            linked += len(text) if links else 0
        if not tag:
            break
        _, at, closes, name, attrs = tag
        if not name:
            continue
        if closes:
            close_to(open_.closed_by(name))
            continue
        if (name == "body" and open_.named["head"]) or (stack[-1][0] == "head" and name not in IN_HEAD):
            close_to(open_.deepest({"head"}))
        if name in ("input", "select", "textarea", "button") and not skipping and "hidden" not in attrs.lower():
            page.inputs[stack[-1][1]] += 1
        if name in VOID:
            if not skipping:
                if name not in INLINE:
                    flush()
                pieces.append(" ")
            continue
        close_to(open_.ended_by(name))
        if name not in INLINE:
            flush()
        node = stack[-1][1]
        if name not in INLINE and not skipping and name not in SKIP:
            page.tag.append(name)
            page.parent.append(node)
            page.attrs.append(attrs)
            page.inputs.append(0)
            node = len(page.tag) - 1
        open_.push(name, node)
        skipping += name in SKIP
        links += name == "a"
        if name in RAW and not attrs.rstrip().endswith("/"):
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(source, at)
            close_to(len(stack) - 1)
            at = (source.find(">", stop.end()) + 1 or end) if stop else end
    close_to(1)
    flush()
    return page


def _marks(attrs: str) -> tuple[int, int]:
    against = good = 0
    for groups in _NAMED.findall(attrs):
        for token in _TOKEN.findall(" ".join(groups)):
            token = token.lower()
            against += token in AGAINST
            good += token in FOR
    return against, good


def node_features(page: Page) -> np.ndarray:
    """One row for each node."""
    n = len(page.tag)
    parent = np.array(page.parent)
    kind = np.array([KIND.get(t, len(KINDS)) for t in page.tag])
    own = np.zeros((n, 8))  # characters, link characters, words, sentence marks, digits, upper case, blocks, inputs
    begin = np.full(n, np.inf)
    seen = 0
    for node, text, linked in page.blocks:
        own[node] += (len(text), linked, text.count(" ") + 1, text.count(".") + text.count(",") + text.count("!") + text.count("?"), 0, sum(map(str.isupper, text)) / len(text), 1, 0)
        begin[node] = min(begin[node], seen)
        seen += len(text)
    own[:, 7] = page.inputs
    sub, tags, last = own.copy(), np.ones(n), np.zeros(n)
    children = np.zeros(n)
    for v in range(n - 1, 0, -1):  # children come behind their parents
        p = parent[v]
        sub[p] += sub[v]
        tags[p] += tags[v]
        children[p] += 1
        begin[p] = min(begin[p], begin[v])
        last[p] = max(last[p], last[v])
    depth, bad, good = np.zeros(n), np.zeros(n), np.zeros(n)
    over_bad, over_good = np.zeros(n), np.zeros(n)
    marks = np.array([_marks(a) if a else (0, 0) for a in page.attrs], float).reshape(n, 2)
    above = np.zeros((n, len(KINDS) + 1))
    above[np.arange(n), kind] = 1
    for v in range(1, n):
        p = parent[v]
        depth[v] = depth[p] + 1
        over_bad[v] = max(over_bad[p], marks[p, 0])
        over_good[v] = max(over_good[p], marks[p, 1])
        above[v] = np.maximum(above[v], above[p])
    bad, good = marks.T
    up = np.where(parent < 0, 0, parent)
    group = up * (len(KINDS) + 1) + kind
    of = np.unique(group, return_inverse=True)[1]
    like = np.bincount(of)[of]
    mean = (np.bincount(of, sub[:, 0]) / np.bincount(of))[of]
    long = (np.bincount(of, sub[:, 0] >= 60) / np.bincount(of))[of]
    chars, words = np.maximum(sub[:, 0], 1), np.maximum(sub[:, 2], 1)
    density = np.column_stack([
        np.log1p(sub[:, 0]), np.log1p(own[:, 0]), sub[:, 1] / chars, np.log1p(words), sub[:, 0] / tags, sub[:, 3] / words,
        sub[:, 5] / np.maximum(sub[:, 6], 1), sub[:, 2] / np.maximum(sub[:, 6], 1), sub[:, 0] / max(1, seen),
        np.where(np.isfinite(begin), begin, seen) / max(1, seen), sub[:, 0] / chars[up], sub[up, 1] / chars[up],
        children, depth, like, np.log1p(mean), long, sub[:, 0] / np.maximum(mean, 1), bad, good, over_bad, over_good,
        sub[:, 7], sub[:, 7] / words,
    ])
    return np.column_stack([density, kind[:, None] == np.arange(len(KINDS) + 1), above]).astype(np.float32)


@dataclass
class Forest:
    """Boosted trees of equal depth: ``feature`` and ``cut`` by tree and heap place, ``leaf`` by tree and leaf."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1]))
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            out += leaf[at - (len(leaf) - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, least: float = 4.0) -> Forest:
    """Logistic boosting with histograms over quantile bins."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    z = np.full(len(y), base)
    inner, leaves = (1 << depth) - 1, 1 << depth
    feature, cut, leaf = (np.zeros((rounds, k), t) for k, t in ((inner, np.int64), (inner, np.float64), (leaves, np.float64)))
    width = x.shape[1]
    column = np.arange(width) * bins
    for t in range(rounds):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, n = (1 << level) - 1, 1 << level
            cell = ((at - first)[:, None] * width * bins + column + binned).ravel()
            sums = [np.bincount(cell, np.repeat(w, width), n * width * bins).reshape(n, width, bins).cumsum(axis=2) for w in (g, h)]
            gl, hl = sums
            gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
            gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1)
            gain[(hl < least) | (ht - hl < least)] = -1
            for j, c in enumerate(cuts):
                gain[:, j, len(c) :] = -1
            best = gain.reshape(n, -1).argmax(axis=1)
            useful = gain.reshape(n, -1)[np.arange(n), best] > gt[:, 0, 0] ** 2 / (ht[:, 0, 0] + 1) + 1e-9
            for k in range(n):
                j, b = divmod(int(best[k]), bins)
                feature[t, first + k] = j
                cut[t, first + k] = cuts[j][b] if useful[k] else np.inf
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[t, at]] > cut[t, at])
        at -= inner
        leaf[t] = rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + 1)
        z += leaf[t, at]
    return Forest(base, feature, cut, leaf)


def decode(parent: list[int], logit: np.ndarray) -> np.ndarray:
    """The best set of nodes that holds the parent of each of its nodes; the root is always kept."""
    gain = logit.copy()
    for v in range(len(parent) - 1, 0, -1):
        gain[parent[v]] += max(0.0, gain[v])
    keep = np.zeros(len(parent), bool)
    keep[0] = True
    for v in range(1, len(parent)):
        keep[v] = keep[parent[v]] and gain[v] > 0
    return keep


def main_texts(sources: list[str], model: Forest) -> list[str]:
    """The kept blocks of each page, one per line; the nodes of all pages are scored together."""
    pages = [parse(s) for s in sources]
    rows = [node_features(p) for p in pages if p.blocks]
    logit = model.score(np.concatenate(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for page in pages:
        if not page.blocks:
            out.append("")
            continue
        keep = decode(page.parent, logit[at : at + len(page.tag)])
        at += len(page.tag)
        out.append("\n".join(text for node, text, _ in page.blocks if keep[node]))
    return out


def main_text(source: str, model: Forest) -> str:
    return main_texts([source], model)[0]


def content_nodes(page: Page, inside: np.ndarray) -> np.ndarray:
    """Labels of nodes from those of blocks: 1 if the subtree holds a content block, nodes without text 0."""
    out = np.zeros(len(page.tag))
    for (node, _, _), good in zip(page.blocks, inside):
        if good:
            while node >= 0 and not out[node]:
                out[node] = 1
                node = page.parent[node]
    return out


def article_blocks(page: Page) -> np.ndarray | None:
    """Which blocks stand in the page's own article and in no boilerplate element; None without an article."""
    state = np.zeros(len(page.tag), int)
    for v in range(1, len(page.tag)):
        state[v] = state[page.parent[v]]
        if page.tag[v] in ("article", "main") and not state[v]:
            state[v] = 1
        if page.tag[v] in ("nav", "footer", "aside", "header") or _marks(page.attrs[v])[0]:
            state[v] = 2
    inside = np.array([state[node] == 1 for node, _, _ in page.blocks])
    return inside if inside.any() else None


# Ways to write boilerplate and content in the rebuilt pages: element and attribute; fixed values.
LAYOUTS = {
    "menu": ['nav', 'div class="menu"', 'ul class="navigation"', 'div id="top-nav"', 'div'],
    "header": ['header', 'div class="site-header"', 'div id="masthead"', 'div'],
    "footer": ['footer', 'div id="footer"', 'div class="copyright"', 'div'],
    "side": ['aside', 'div class="sidebar"', 'div id="related"', 'section class="recommended"', 'div class="widget"'],
    "notice": ['div class="cookie-notice"', 'div id="consent-banner"', 'div class="newsletter popup"', 'section class="notice"'],
    "advert": ['div class="ad"', 'div class="advertisement"', 'aside class="promo"', 'div id="sponsored"'],
    "comments": ['div id="comments"', 'section class="comments"', 'ol class="comment-list"', 'div class="replies"'],
    "content": ['article', 'main', 'div class="post-content"', 'div id="content"', 'div class="entry"', 'section class="story"', 'div', 'div class="article-body"', 'section'],
}


def rebuilt(content: list[str], rest: list[str], rng: np.random.Generator) -> tuple[str, np.ndarray]:
    """A page with the given texts in a layout drawn by chance, and which of its blocks are content."""
    out: list[str] = []
    inside: list[bool] = []
    escape = lambda t: entities.escape(t)

    def add(place: str, texts: list[str], tag: str, good: bool, link: float = 0.0) -> None:
        if few and not good:
            return
        layout = LAYOUTS[place][rng.integers(len(LAYOUTS[place]))]
        out.append(f"<{layout}>")
        listed = layout.split()[0] in ("ul", "ol")
        for t in texts:
            each = "li" if listed else tag
            body = escape(t)
            out.append(f"<{each}>" + (f'<a href="#">{body}</a>' if rng.random() < link else body) + f"</{each}>")
            inside.append(good)
        out.append(f"</{layout.split()[0]}>")

    few = rng.random() < 0.2  # nothing but the content
    words = " ".join(rest or content).split() or ["text"]
    short = lambda n, size: [" ".join(words[i : i + size]) for i in rng.integers(0, len(words), n)]
    longer = lambda n: short(n, int(rng.integers(6, 40)))
    if rng.random() < 0.6:
        add("header", short(int(rng.integers(1, 3)), 3), "div", False, 0.5)
    if rng.random() < 0.85:
        add("menu", short(int(rng.integers(3, 9)), 1), "li" if rng.random() < 0.6 else "div", False, 0.97)
    if rng.random() < 0.4:
        add("notice", longer(1), "p", False)
    if rng.random() < 0.4:
        add("advert", longer(int(rng.integers(1, 3))), "p" if rng.random() < 0.5 else "div", False, 0.3)
    wrapped = rng.random() < 0.5
    out += ['<div class="wrapper">'] * wrapped
    if rng.random() < 0.3:
        add("side", longer(int(rng.integers(1, 4))), "p", False, 0.5)
    bare = rng.random() < (0.5 if few else 0.1)
    place = LAYOUTS["content"][rng.integers(len(LAYOUTS["content"]))]
    out += [f"<{place}>"] * (not bare)
    if rng.random() < 0.1:  # texts without marks
        content = [re.sub(r"[^\w\s]+", "", t).lower() or t for t in content]
    if rng.random() < 0.1:  # one long block
        content = [" ".join(content * int(rng.integers(1, 4)))]
    if rng.random() < 0.15:  # a note of few words
        content = [" ".join(t.split()[: rng.integers(1, 8)]) for t in content[: rng.integers(1, 4)]]
    for k, t in enumerate(content):
        each = "h1" if not k and rng.random() < 0.6 else "h2" if len(t) < 60 and rng.random() < 0.3 else "p" if rng.random() < 0.88 else ("li", "blockquote", "div", "pre", "h3")[rng.integers(5)]
        out.append(f"<ul><li>{escape(t)}</li></ul>" if each == "li" else f"<{each}>{escape(t)}</{each}>")
        inside.append(True)
        if rng.random() < 0.06:
            add("advert", longer(1), "p", False)
    out += [f"</{place.split()[0]}>"] * (not bare)
    if rng.random() < 0.4:
        add("side", longer(int(rng.integers(1, 4))), "p" if rng.random() < 0.5 else "li", False, 0.6)
    if rng.random() < 0.45:
        add("comments", longer(int(rng.integers(1, 5))), "p" if rng.random() < 0.5 else "div", False)
    out += ["</div>"] * wrapped
    if rng.random() < 0.85:
        add("footer", short(int(rng.integers(1, 3)), int(rng.integers(3, 14))), "p" if rng.random() < 0.5 else "div", False, 0.2)
    if len(inside) % 7 == 3:  # the whole page in one form
        out.insert(0, '<form><input name="q"><button>Go</button>')
        out.append("</form>")
    return "<html><body>" + "".join(out) + "</body></html>", np.array(inside)


def fit_forest(pages: list[str], rebuilds: int = 4, seed: int = 3) -> Forest:
    """Trees from sample pages that mark their article; without any, from texts made of a few syllables."""
    rng = np.random.default_rng(seed)
    x, y = [], []
    usable = []
    for source in pages:
        page = parse(source)
        inside = article_blocks(page)
        if inside is not None:
            usable.append(([t for (_, t, _), g in zip(page.blocks, inside) if g], [t for (_, t, _), g in zip(page.blocks, inside) if not g]))
            x.append(node_features(page))
            y.append(content_nodes(page, inside))
    while len(usable) < 40:
        word = lambda: "".join(rng.choice(["ka", "lo", "mi", "ter", "an", "is"], rng.integers(1, 4)))
        usable.append(([" ".join(word() for _ in range(rng.integers(4, 60))).capitalize() + "." for _ in range(rng.integers(2, 9))], [" ".join(word() for _ in range(12))]))
    for content, rest in usable:
        for _ in range(rebuilds):
            source, inside = rebuilt(content, rest, rng)
            page = parse(source)
            if len(page.blocks) == len(inside):
                x.append(node_features(page))
                y.append(content_nodes(page, inside))
    return boost(np.concatenate(x), np.concatenate(y))


def extract_text(pages: DataFrame, sample: int = 250, longest: int = 100_000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` of every page, from its whole html.

    The model is fitted on about ``sample`` pages of at most ``longest`` characters, drawn by hash (the bound
    of the fit). Null and empty pages have an empty text; a page without tags is one block; null ids and
    repeated rows stay; further columns are not read; an empty table gives no rows.
    """
    slim = pages.select(F.col(id_col).alias("i"), F.col(url_col).alias("u"), F.coalesce(F.col(html_col), F.lit("")).alias("s"))
    fit = slim.where(F.length("s").between(1, longest))
    drawn = fit.where(hash_share(fit.count(), sample, "i", "u")).select("s").limit(2 * sample).collect()
    held = pages.sparkSession.sparkContext.broadcast(fit_forest(sorted(r["s"] for r in drawn)))

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            sources = list(part)
            groups = [sources[lo:hi] for lo, hi in blocks([len(s) for s in sources])]
            yield pd.Series([t for group in groups for t in main_texts(group, held.value)], dtype=object)

    out = slim.select(F.col("i").alias(id_col), F.col("u").alias(url_col), run("s").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
