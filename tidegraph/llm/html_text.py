"""Main text of web pages by a tree-structured graphical model over the DOM.

Each block element of a page is a node with a hidden label, content or not. A node's own potential comes from its tag, its
class and id words, the length of its own text, how much of that is links, and where it stands; parent-child potentials,
by the kind of the child, tie the labels along the tree. Sum-product messages go up from the leaves to the root and down
again, which on a tree gives exact marginals. Weights are trained by gradient ascent on the likelihood of labelled pages,
the same messages giving the gradient. The labelled pages are written by `labelled_pages`, a generator of varied layouts in
which every block's label is known; no page of the input is needed for training, so a page's text depends on it alone.

Scale: one pass without a shuffle; a batch's pages are one forest, so messages move a level at a time for all of them.
"""

from __future__ import annotations

import functools
import html
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

# ---------------------------------------------------------------------------------------------------- parsing

GROUPS = {  # of tags, by the part that they play
    "page": "html body", "article": "article main", "section": "section div center details", "heading": "h1 h2 h3 h4 h5 h6 summary hgroup",
    "text": "p pre blockquote address figure figcaption dl dt dd", "list": "ul ol li menu dir", "table": "table tbody thead tfoot tr td th caption",
    "frame": "nav header footer aside dialog", "form": "form fieldset legend label button select option optgroup textarea input",
}
GROUP_NAMES = list(GROUPS)
TAGS = {t: i for i, t in enumerate(t for g in GROUPS.values() for t in g.split())}
GROUP_OF = {t: i for i, g in enumerate(GROUPS.values()) for t in g.split()}
INLINE = {"label", "input"}
BLOCK = set(TAGS) - INLINE
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("script style title noscript template iframe textarea select annotation annotation-xml metadata desc defs".split())  # never shown, or a form
RAW = set("script style title textarea iframe noscript".split())  # text up to their own end tag, whatever it looks like
FOREIGN = {"svg", "math"}  # only within these does a slash end an element where it begins
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"}, "option": {"option"}}
BARRIER = {"table", "ul", "ol", "dl", "body", "html", "article", "section", "div", "td", "th", "menu", "select"}
# A tag's quoted values may hold anything. A quote that is never closed, or only by the quote that opens another tag's value,
# holds nothing: such a tag ends at its first '>' or before the next '<'.
_QUOTED = "|".join(f"{q}[^{q}<]*+(?:<(?![a-zA-Z/])[^{q}<]*+)*+{q}|{q}[^{q}]*+{q}(?<!={q})" for q in "\"'")
_TOKEN = re.compile(rf"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|{_QUOTED})*+)>|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*+)(?:>|(?=<))", re.S)
_ATTR = re.compile(r"""(?:\A|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CUT_TAG = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*>?", re.I | re.A) for t in RAW}
_WORD = re.compile(r"[a-z]+")

#: Words of class and id attributes that say what a block is for.
KEYWORDS = {
    "content": "content article post entry story body text main hentry prose",
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs pagination pager toc tabs skip topbar",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner adsense dfp",
    "side": "sidebar side aside widget rail related recommended popular trending more tags tag",
    "comment": "comment comments commentlist disqus reply replies respond discussion reader readers",
    "notice": "notice cookie cookies consent gdpr alert warning popup modal overlay newsletter subscribe signup paywall",
    "frame": "header footer foot masthead copyright legal disclaimer site bottom top logo branding",
    "social": "share sharing social follow likes rating meta byline author date",
    "form": "form search login contact input field",
}
KEYWORD_OF = {w: i for i, ws in enumerate(KEYWORDS.values()) for w in ws.split()}


class Page:
    """The block elements of a page as a tree, and its runs of text in order."""

    __slots__ = ("parent", "depth", "tag", "words", "runs")

    def __init__(self, source: str):
        self.parent, self.depth, self.tag, self.words = [-1], [0], ["html"], [()]
        self.runs: list[tuple[int, str, int]] = []  # node, text, characters of it in links
        stack, parts, linked, in_link, at, skip, pos, foreign = [0], [], 0, False, 0, None, 0, 0

        def flush():
            nonlocal parts, linked
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    self.runs.append((stack[-1], text, min(linked, len(text))))
                parts, linked = [], 0

        def say(raw: str):
            nonlocal linked
            if raw:
                text = html.unescape(raw) if "&" in raw else raw
                parts.append(text)
                if in_link:
                    linked += len(text)

        while m := _TOKEN.search(source, pos):
            close, name, attrs, pos = m[1] or m[4], m[2] or m[5], m[3] if m[2] else m[6], m.end()
            name = name and name.lower()
            if skip is None:
                say(source[at : m.start()])
                at = pos
            alone = foreign > 0 and bool(attrs) and attrs.endswith("/")
            if name in RAW and not close and not alone:  # no tokens before its end tag
                end = _RAW_END[name].search(source, pos)
                pos = end.end() if end else len(source)
                at = pos if skip is None else at
                continue
            if skip is not None:  # inside an element whose text is not shown
                if close and name == skip:
                    skip, at = None, pos
                continue
            if name is None:
                continue
            if name in FOREIGN:
                foreign = max(0, foreign - 1) if close else foreign + (not attrs.endswith("/"))
            if name in UNSEEN:
                if not close and not alone:
                    skip = name
                continue
            if name == "a":
                in_link = not close
            elif name == "br" or name == "hr":
                parts.append(" ")
            if name not in BLOCK:
                continue
            flush()
            if close:
                for k in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[k]] == name:
                        del stack[k:]
                        break
                in_link = False
                continue
            if name == "html" or (name == "body" and "body" in self.tag):
                continue
            for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if self.tag[stack[k]] == "p":
                    del stack[k:]
                    break
                if self.tag[stack[k]] in BARRIER:
                    break
            for k in range(len(stack) - 1, 0, -1):
                open_tag = self.tag[stack[k]]
                if open_tag in CLOSES.get(name, ()):
                    del stack[k:]
                    break
                if open_tag in BARRIER and open_tag not in ("td", "th"):
                    break
            words = ()
            if attrs and "=" in attrs:
                words = tuple(w for a in _ATTR.finditer(attrs) for w in _WORD.findall((a[1] or a[2] or a[3] or "").lower()))
            self.parent.append(stack[-1])
            self.depth.append(self.depth[stack[-1]] + 1)
            self.tag.append(name)
            self.words.append(words)
            stack.append(len(self.tag) - 1)
        if skip is None:
            say(_CUT_TAG.sub("", source[at:]))
        flush()


# --------------------------------------------------------------------------------------------------- features

_FRAMES = [GROUP_NAMES.index(g) for g in ("frame", "form")]
_LENGTHS = np.array([1, 20, 60, 150, 400, 1000])
_N_KEY = len(KEYWORDS)
_OFF = np.cumsum([0, len(TAGS), len(GROUPS), _N_KEY, _N_KEY, 7, 5, 4, 7, 3, 7])
N_FEATURES = int(_OFF[-1])


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    """The nodes of each depth, in order."""
    return np.split(np.argsort(depth, kind="stable"), np.cumsum(np.bincount(depth))[:-1])


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the forest of the pages: (node, feature) pairs as two arrays, parents, groups of kinds, depths."""
    base = np.concatenate(([0], np.cumsum([len(p.tag) for p in pages])))
    n = int(base[-1])
    parent = np.concatenate([np.where((q := np.array(p.parent)) < 0, -1, q + b) for p, b in zip(pages, base, strict=False)])
    depth = np.concatenate([np.array(p.depth) for p in pages])
    own, linked, stops = np.zeros(n), np.zeros(n), np.zeros(n)
    key = np.zeros((n, _N_KEY), bool)
    tag, group = np.zeros(n, int), np.zeros(n, int)
    for p, b in zip(pages, base, strict=False):
        for node, text, link in p.runs:
            own[b + node] += len(text)
            linked[b + node] += link
            stops[b + node] += text.count(". ") + (text[-1] in ".!?…。")
        for i, (t, ws) in enumerate(zip(p.tag, p.words, strict=True)):
            tag[b + i], group[b + i] = TAGS[t], GROUP_OF[t]
            for w in ws:
                if (k := KEYWORD_OF.get(w)) is not None:
                    key[b + i, k] = True
    above = key.copy()  # a key word of any element around
    total, total_link = own.copy(), linked.copy()
    levels = _levels(depth)
    for idx in levels[1:]:
        above[idx] |= above[parent[idx]]
    for idx in levels[:0:-1]:
        np.add.at(total, parent[idx], total[idx])
        np.add.at(total_link, parent[idx], total_link[idx])
    up = np.where(parent >= 0, parent, 0)
    fix = [
        _OFF[0] + tag, _OFF[1] + np.where(parent >= 0, group[up], 0), _OFF[4] + np.searchsorted(_LENGTHS, own, side="right"),
        _OFF[5] + np.minimum((5 * np.where(own > 0, linked / np.maximum(own, 1), total_link / np.maximum(total, 1))).astype(int), 4),
        _OFF[6] + np.minimum(stops, 3).astype(int), _OFF[7] + np.searchsorted(_LENGTHS, total, side="right"), _OFF[8] + np.minimum(np.maximum(depth - 1, 0) // 2, 2),
    ]
    node, feat = [np.tile(np.arange(n), len(fix))], [np.concatenate(fix)]
    quiet = np.flatnonzero(~above.any(1) & ~np.isin(group, _FRAMES))  # nothing says what it is: its length says more then
    node.append(quiet)
    feat.append(_OFF[9] + np.searchsorted(_LENGTHS, own[quiet], side="right"))
    for off, m in ((_OFF[2], key), (_OFF[3], above & ~key)):
        i, j = np.nonzero(m)
        node.append(i)
        feat.append(off + j)
    return np.concatenate(node), np.concatenate(feat), parent, group, depth


def messages(score: np.ndarray, pair: np.ndarray, parent: np.ndarray, group: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum-product on the forest: P(content) of each node, and (node, parent label, own label) marginals."""
    n = len(score)
    up, sent = np.zeros((n, 2)), np.zeros((n, 2))
    up[:, 1] = score
    levels = _levels(depth)
    for idx in levels[:0:-1]:
        x = up[idx][:, None, :] + pair[group[idx]]
        sent[idx] = np.logaddexp(x[:, :, 0], x[:, :, 1])
        np.add.at(up, parent[idx], sent[idx])
    belief, both = up.copy(), np.zeros((n, 2, 2))
    for idx in levels[1:]:
        rest = belief[parent[idx]] - sent[idx]
        x = rest[:, :, None] + pair[group[idx]] + up[idx][:, None, :]
        x -= x.max((1, 2), keepdims=True)
        e = np.exp(x)
        both[idx] = e / e.sum((1, 2), keepdims=True)
        belief[idx] = np.log(np.maximum(both[idx].sum(1), 1e-300))
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), both


# ---------------------------------------------------------------------------------------------- labelled pages

_SYLLABLES = "ta re mi lo ka se ni vo du pa el or an ist und que tion er".split()


def _text(r: random.Random, words: int, stop: bool = True) -> str:
    out = ["".join(r.choices(_SYLLABLES, k=r.randint(1, 4))) for _ in range(max(1, words))]
    if stop:
        for i in range(0, len(out), max(4, words // max(1, words // 12))):
            out[i] = out[i].capitalize() + ("." if i % 2 else "")
        out[-1] += "."
    return " ".join(out)


def labelled_pages(n: int, seed: int = 5) -> list[tuple[str, str]]:
    """(html, main text): pages in varied layouts, marked up while they are written."""
    r, out = random.Random(seed), []
    for _ in range(n):
        said: list[str] = []

        def block(tag: str, words: int, good: bool, attrs: str = "", stop: bool = True, link: bool = False) -> str:
            t = _text(r, words, stop)
            if good:
                said.append(t)
            inner = f'<a href="/x">{t}</a>' if link else t if r.random() < 0.8 else f"<b>{t}</b>"
            end = "" if tag in ("p", "li") and r.random() < 0.2 else f"</{tag}>"
            return f"<{tag}{attrs}>{inner}{end}"

        def cls(kind: str) -> str:
            a, w = r.choice(["class", "class", "id"]), r.choice(KEYWORDS[kind].split())
            return f' {a}="{r.choice(["", "", "x-", "js "])}{w}{r.choice(["", "", "-box", " wide", "_1"])}"'

        def links(k: int) -> str:
            return "<ul>" + "".join(f'<li><a href="/{i}">{_text(r, r.randint(1, 4), False)}</a></li>' for i in range(k)) + "</ul>"

        def within(tag: str, kind: str, inner: str) -> str:
            """In its own element, or in a div that says what it is."""
            own = r.random() < 0.5
            return f"<{tag if own else 'div'}{cls(kind) if not own or r.random() < 0.4 else ''}>{inner}</{tag if own else 'div'}>"

        def boiler(kind: str, tag: str = "") -> str:
            if kind == "nav":
                return within("nav", "nav", links(r.randint(2, 8)))
            if kind == "ad":
                return f"<{tag or 'div'}{cls('ad')}>" + r.choice([_text(r, r.randint(3, 40)), block("p", r.randint(3, 40), False), block("p", r.randint(3, 15), False, link=True)]) + f"</{tag or 'div'}>"
            if kind == "side":
                return within("aside", "side", block("h3", 2, False, stop=False) + r.choice([links(r.randint(2, 7)), block("p", r.randint(5, 40), False)]))
            if kind == "comment":
                tag = r.choice(["div", "section", "ol"])
                return f"<{tag}{cls('comment')}>" + block("h3", 2, False, stop=False) + "".join(r.choice(["<div class=\"comment\">" + block("p", r.randint(4, 60), False) + "</div>", block("p", r.randint(4, 60), False)]) for _ in range(r.randint(1, 5))) + f"</{tag}>"
            if kind == "notice":
                return f"<div{cls('notice')}>" + r.choice([_text(r, r.randint(4, 30)), block("p", r.randint(4, 30), False)]) + "</div>"
            if kind == "form":
                return f"<form{cls('form') if r.random() < 0.5 else ''}>" + r.choice([block("p", r.randint(2, 12), False), _text(r, 4, False), "<label>" + _text(r, 2, False) + "</label><input name=q>"]) + "<button>" + _text(r, 1, False) + "</button></form>"
            if kind == "footer":
                return within("footer", "frame", r.choice(["&copy; x &middot; " + _text(r, r.randint(2, 15)), block("p", r.randint(3, 30), False), links(3)]))
            return within("header", "frame", r.choice([block("h1", 3, False, stop=False), block("p", r.randint(2, 10), False), links(3)]))

        top = [boiler(k) for k in ("header", "nav", "notice", "ad", "form") if r.random() < 0.5]
        r.shuffle(top)
        body = []
        plain = r.random() < 0.3  # nothing around the text says what it is
        para = "div" if plain and r.random() < 0.5 else "p"
        if r.random() < 0.8:
            title = block("h1", r.randint(1, 12), True, stop=r.random() < 0.5)
            body.append(f"<header>{title}</header>" if not plain and r.random() < 0.15 else title)
        for _i in range(r.choice([1, 2, 3, 5, 8, 12])):
            x = r.random()
            if x < 0.64:
                body.append(block(para, r.choice([1, 2, 4, 10, 30, 60, 120] if para == "p" else [10, 30, 60, 120]), True))
            elif x < 0.67:
                body.append(block("div", r.choice([10, 30, 60, 120]), True))
            elif x < 0.72:  # a class that promises something else, about much text
                body.append(f"<div{cls(r.choice(['side', 'social', 'content', 'frame']))}>" + "".join(block("p", r.choice([30, 60, 120]), True) for _ in range(r.randint(1, 3))) + "</div>")
            elif x < 0.78:
                body.append(block(r.choice(["h2", "h3"]), r.randint(1, 6), True, stop=False))
            elif x < 0.84:
                tag = r.choice(["ul", "ol"])
                body.append(f"<{tag}>" + "".join(block("li", r.randint(1, 20), True) for _ in range(r.randint(2, 4))) + f"</{tag}>")
            elif x < 0.88:
                body.append("<blockquote>" + block("p", r.randint(5, 40), True) + "</blockquote>")
            elif x < 0.91:
                body.append("<table>" + "".join("<tr>" + block("td", r.randint(1, 5), True, stop=False) + block("td", r.randint(1, 5), True, stop=False) + "</tr>" for _ in range(2)) + "</table>")
            else:
                body.append(boiler(r.choice(["ad", "side", "form", "notice", "ad"])))
        frame = r.choice([("<article>", "</article>")] * 3 + [(f"<article{cls('content')}>", "</article>"), ("<main>", "</main>"), (f"<div{cls('content')}>", "</div>"), ("<main><article>", "</article></main>"), (f"<div class=\"wrap\"><div{cls('content')}>", "</div></div>"), ("<section>", "</section>")])
        if plain:
            frame = r.choice([("<div>", "</div>"), ("<div>", "</div>"), ("", ""), ("<div><div>", "</div></div>"), ("<section><div>", "</div></section>"), ("<center>", "</center>")])
        tail = [boiler(k) for k in ("comment", "side", "ad", "form") if r.random() < 0.4]
        inside = r.random() < 0.2
        page = "".join(top) + frame[0] + "".join(body) + ("".join(tail) if inside else "") + frame[1] + ("" if inside else "".join(tail)) + (boiler("footer") if r.random() < 0.8 else "")
        if r.random() < 0.3:
            page = f'<div class="{r.choice(["page", "container", "wrapper"])}">{page}</div>'
        out.append((f"<!DOCTYPE html><html><head><title>{_text(r, 4)}</title></head><body>{page}</body></html>", "\n".join(said)))
    return out


@functools.lru_cache(maxsize=2)
def train(n_pages: int = 600, rounds: int = 120, rate: float = 0.15, decay: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights and pair potentials that maximise the likelihood of the labelled pages."""
    pages, labels = [], []
    for source, text in labelled_pages(n_pages):
        p, good = Page(source), set(text.split("\n"))
        own = [None] * len(p.tag)
        for node, run, _ in p.runs:
            own[node] = int(run in good)
        for i in range(len(own) - 1, 0, -1):  # an element around content is content
            if own[i] is None:
                own[i] = 0
            if own[i] == 1 and own[p.parent[i]] is None:
                own[p.parent[i]] = 1
        own[0] = own[0] or 0
        pages.append(p)
        labels.extend(own)
    node, feat, parent, group, depth = features(pages)
    y = np.array(labels, float)
    child = parent >= 0
    truth = np.zeros((len(y), 2, 2))
    truth[np.flatnonzero(child), y[parent[child]].astype(int), y[child].astype(int)] = 1
    w, pair = np.zeros(N_FEATURES), np.zeros((len(GROUPS), 2, 2))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(pair), np.zeros_like(pair)]
    for t in range(1, rounds + 1):
        score = np.bincount(node, w[feat], len(y))
        p, both = messages(score, pair, parent, group, depth)
        gw = np.bincount(feat, (y - p)[node], N_FEATURES) / len(y) - decay * w
        gp = np.zeros_like(pair)
        np.add.at(gp, group[child], (truth - both)[child])
        gp = gp / len(y) - decay * pair
        for x, g, m, v in ((w, gw, state[0], state[1]), (pair, gp, state[2], state[3])):  # Adam
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w, pair


def marginals(pages: list[Page], w: np.ndarray, pair: np.ndarray) -> list[np.ndarray]:
    node, feat, parent, group, depth = features(pages)
    p, _ = messages(np.bincount(node, w[feat], len(parent)), pair, parent, group, depth)
    return np.split(p, np.cumsum([len(x.tag) for x in pages])[:-1])


def main_texts(sources: list[str | None], w: np.ndarray, pair: np.ndarray, least: float = 0.5) -> list[str]:
    pages = [Page(s or "") for s in sources]
    return ["\n".join(text for node, text, _ in p.runs if m[node] >= least) for p, m in zip(pages, marginals(pages, w, pair), strict=True)]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages (page_id, url, html).

    Nulls: a null or empty html gives an empty text; ids and urls go through as they are. Repeated rows: a row each. No
    rows: no rows. Other columns are ignored. Cut pages are read as far as they go: an open tag or comment at the end is
    dropped, open elements end with the page.
    """
    w, pair = train()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = main_texts(batch.column(2).to_pylist(), w, pair)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return arrow_map(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")), run, "page_id long, url string, text string, n_chars long", 200)
