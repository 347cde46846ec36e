"""Main text of web pages by a tree-structured graphical model over the nodes of a page.

Every element is content or not. Its features (tag, words of its class and id, length of its own
text, share of text in links) give a potential, and so does every pair of parent and child, by the
kind of the child. Sum-product messages run from the leaves to the root and back and give each
element's marginal; the text of elements that are content with probability 0.5 or more is kept.

The weights maximise the likelihood of labelled pages, whose gradient is the difference between
observed and expected features under the same messages. The labelled pages are made here from a
few layouts with their labels, as no table has any; they hold no text of the pages to extract.
"""

from __future__ import annotations

import functools
import html
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import bounded_batches

TRAIN_PAGES = 240
STEPS = 300
SEED = 3

# Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "template", "noscript"}
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre "
    "section select summary table tbody td tfoot th thead title tr ul script style textarea template noscript".split()
)
TAGS = sorted(BLOCK | {"a", "b", "i", "em", "strong", "span", "button", "label", "input", "img", "small", "code", "iframe"})
# An open element of the first kind ends where one of the second begins, up to a stopping element.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
WORDS = {
    "menu": "nav navbar navigation menu menubar topbar breadcrumb breadcrumbs pagination pager toc skip tabs",
    "head": "header masthead banner hero logo branding",
    "foot": "footer foot colophon copyright legal",
    "side": "sidebar side aside widget widgets rail related recommended trending complementary",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion dfp adslot banner-ad",
    "notice": "cookie cookies consent notice gdpr popup modal overlay alert newsletter-popup disclaimer toast",
    "comment": "comment comments reply replies respond discussion disqus reviews commentlist thread",
    "form": "form search login signup subscribe subscription newsletter contact register",
    "share": "share sharing social follow tags meta byline tools",
    "content": "content article post entry story main body text page-content post-content entry-content articlebody",
}
GROUP_OF = {w: i for i, ws in enumerate(WORDS.values()) for w in ws.split()}
TAG_OF = {t: i for i, t in enumerate(TAGS)}
LENGTHS = (1, 20, 80, 250)
LINKS = (0.001, 0.3, 0.7)
N_TAGS, N_WORDS, N_LENGTHS, N_LINKS = len(TAGS) + 1, len(WORDS), len(LENGTHS) + 1, len(LINKS) + 1
FEATURES = N_TAGS + N_WORDS + N_LENGTHS + N_LINKS
KINDS = 3  # of children: block, inline, sectioning
SECTIONS = {"article", "aside", "footer", "form", "header", "main", "nav", "section", "script", "style"}

# A plain tag holds no other angle bracket, so that looking for it stops at the next one.
START = re.compile(
    r"<(?:!--|!\[CDATA\[|[!?]"
    r"|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>\"']*+)(?P<rest>(?:[\s/](?:[^<>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)?+)>"
    r"|(?P<odd>/?)[a-zA-Z])"
)
MARK = re.compile(r"[>\"']")
NAME_END = re.compile(r"[\s/>]")
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
KEEP = re.compile(r"\bdata-keep=1\b")
SPLIT = re.compile(r"[^a-z]+")


class Markup:
    """The markup of a page from left to right. However broken it is, the time follows its length."""

    def __init__(self, source: str):
        self.source, self.last = source, source.rfind(">")
        self.dead: set[int] = set()  # marks after which no tag ends
        self.name = (0, -1)  # a place, and the end of every name that begins from there on

    @functools.cached_property
    def marks(self) -> list[int]:
        return [m.start() for m in MARK.finditer(self.source)]

    @functools.cached_property
    def quotes(self) -> dict[str, list[int]]:
        return {q: [k for k in self.marks if self.source[k] == q] for q in "\"'"}

    def end_of_name(self, at: int) -> int:
        if not self.name[0] <= at <= self.name[1]:
            found = NAME_END.search(self.source, at)
            self.name = (at, found.start() if found else len(self.source))
        return self.name[1]

    def end_of_tag(self, at: int) -> int:
        """Place of the ``>`` outside quotes that ends a tag, or -1. A quote that never closes is text."""
        passed, k = [], bisect_left(self.marks, at)
        while k < len(self.marks) and k not in self.dead:
            place = self.marks[k]
            mark = self.source[place]
            if mark == ">":
                return place
            passed.append(k)
            same = self.quotes[mark]
            close = bisect_right(same, place)
            k = bisect_right(self.marks, same[close] if close < len(same) else place)
        self.dead.update(passed)
        return -1

    def next(self, at: int):
        """(start, end, whether it closes, tag, rest) of the first markup from ``at``, without tag for comments."""
        for found in START.finditer(self.source, at):
            first, inner = found.span()
            if found["tag"]:
                return first, inner, bool(found["end"]), found["tag"].lower(), found["rest"]
            kind = self.source[first + 1 : inner]
            if kind in ("!--", "![CDATA["):
                ending = "-->" if kind == "!--" else "]]>"
                stop = self.source.find(ending, inner)
                return first, len(self.source) if stop < 0 else stop + len(ending), False, "", ""
            if kind in ("!", "?"):
                if inner <= self.last:
                    return first, self.source.index(">", inner) + 1, False, "", ""
                continue
            name = self.end_of_name(inner)
            stop = self.end_of_tag(name)
            if stop >= 0:
                return first, stop + 1, bool(found["odd"]), self.source[inner - 1 : name].lower(), self.source[name:stop]
        return None


class Page:
    """Elements of a page in order of their start, and its runs of text."""

    def __init__(self, source: str):
        self.tags, self.parents, self.rests = ["#root"], [-1], [""]
        self.runs: list[tuple[int, str]] = []  # (element or -1 for a block border, text)
        self.read(source)

    def open(self, tag: str, rest: str, parent: int) -> int:
        self.tags.append(tag)
        self.parents.append(parent)
        self.rests.append(rest)
        return len(self.tags) - 1

    def read(self, source: str) -> None:
        at, markup = 0, Markup(source)
        self.stack, self.places = [0], defaultdict(list)  # open elements, and the places of each tag among them
        while found := markup.next(at):
            start, end, closing, tag, rest = found
            if start > at:
                self.runs.append((self.stack[-1], source[at:start]))
            at = end
            if not tag:
                continue
            if tag in BLOCK:
                self.runs.append((-1, ""))
            if closing:
                self.close({tag}, set())
                continue
            if tag in BLOCK:
                self.close({"p"}, {"table", "td", "th", "button", "li", "div", "article", "section", "body"})
            if tag in ENDS:
                self.close(*ENDS[tag])
            node = self.open(tag, rest, self.stack[-1])
            if tag in RAW:
                found = re.compile(rf"</{re.escape(tag)}\b", re.I).search(source, at)
                stop = source.find(">", found.end()) if found else -1
                text_end, after = (found.start(), stop + 1) if stop >= 0 else (len(source), len(source))
                if tag not in ("script", "style"):
                    self.runs.append((node, source[at:text_end]))
                self.runs.append((-1, ""))
                at = after
            elif tag not in VOID:
                self.places[tag].append(len(self.stack))
                self.stack.append(node)
            elif tag == "br":
                self.runs.append((self.stack[-1], " "))
        if at < len(source):
            self.runs.append((self.stack[-1], source[at:]))

    def close(self, ended: set[str], stop: set[str]) -> None:
        """Close the innermost open element of ``ended`` and all within it, unless one of ``stop`` is in between."""
        last = lambda tags: max((self.places[t][-1] for t in tags if self.places[t]), default=0)
        place = last(ended)
        if place > last(stop):
            for node in reversed(self.stack[place:]):
                self.places[self.tags[node]].pop()
            del self.stack[place:]

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(element, feature) of all features that are present."""
        count = len(self.tags)
        own, linked = np.zeros(count), np.zeros(count)
        for node, text in self.runs:
            if node >= 0:
                own[node] += len(text.strip())
        whole = own.copy()
        for node in range(count - 1, 0, -1):
            if self.tags[node] == "a":
                linked[node] = whole[node]
            whole[self.parents[node]] += whole[node]
            linked[self.parents[node]] += linked[node]
        first = [TAG_OF.get(t, N_TAGS - 1) for t in self.tags]
        rows, columns = [np.arange(count)], [np.array(first)]
        for node, rest in enumerate(self.rests):
            if rest and (names := NAMES.findall(rest)):
                words = SPLIT.split(" ".join(names).lower())
                groups = sorted({GROUP_OF[w] for w in words if w in GROUP_OF})
                rows.append(np.full(len(groups), node))
                columns.append(np.array(groups, int) + N_TAGS)
        rows += [np.arange(count), np.arange(count)]
        columns.append(np.searchsorted(LENGTHS, own, side="right") + N_TAGS + N_WORDS)
        share = linked / np.maximum(whole, 1)
        columns.append(np.searchsorted(LINKS, share, side="right") + N_TAGS + N_WORDS + N_LENGTHS)
        return np.concatenate(rows), np.concatenate(columns)

    def text(self, keep: np.ndarray) -> str:
        blocks, parts = [], []
        for node, text in [*self.runs, (-1, "")]:
            if node >= 0:
                if keep[node]:
                    parts.append(html.unescape(text))
            elif parts:
                if block := " ".join("".join(parts).split()):
                    blocks.append(block)
                parts = []
        return "\n".join(blocks)


class Forest:
    """The elements of many pages as one set of trees, ordered for messages by depth."""

    def __init__(self, pages: list[Page]):
        sizes = [len(p.tags) for p in pages]
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
        self.parent = np.concatenate([np.array(p.parents) + (s if len(p.parents) else 0) for p, s in zip(pages, self.starts, strict=False)])
        self.parent[self.starts[:-1]] = -1
        tags = [t for p in pages for t in p.tags]
        self.kind = np.array([2 if t in SECTIONS else 0 if t in BLOCK else 1 for t in tags])
        depth = np.zeros(len(tags), int)
        for node, parent in enumerate(self.parent.tolist()):
            if parent >= 0:
                depth[node] = depth[parent] + 1
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(depth.max(initial=0) + 2))
        self.levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        found = [p.features() for p in pages]
        self.rows = np.concatenate([r + s for (r, _), s in zip(found, self.starts, strict=False)])
        self.columns = np.concatenate([c for _, c in found])

    def infer(self, weights: np.ndarray, pairs: np.ndarray):
        """(marginal of content, joint marginals with the parent, by value of parent and child)."""
        unary = np.zeros((len(self.parent), 2))
        unary[:, 1] = np.bincount(self.rows, weights[self.columns], len(self.parent))
        gathered, up = unary.copy(), np.zeros_like(unary)
        for level in self.levels[:0:-1]:
            joint = pairs[self.kind[level]] + gathered[level][:, None, :]
            up[level] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
            np.add.at(gathered, self.parent[level], up[level])
        belief, joints = gathered.copy(), np.zeros((len(self.parent), 2, 2))
        for level in self.levels[1:]:
            outside = belief[self.parent[level]] - up[level]
            joint = pairs[self.kind[level]] + outside[:, :, None]
            belief[level] = gathered[level] + np.logaddexp(joint[:, 0, :], joint[:, 1, :])
            joint = joint + gathered[level][:, None, :]
            joint -= joint.max(axis=(1, 2), keepdims=True)
            joint = np.exp(joint)
            joints[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700))), joints


# ---- labelled pages ----


def labelled_pages(count: int = TRAIN_PAGES, seed: int = SEED) -> list[str]:
    """Pages whose content elements carry data-keep=1, from layouts drawn at random."""
    rng = np.random.default_rng(seed)
    some = lambda n: " ".join("w" * int(k) for k in rng.integers(2, 9, n))
    pick = lambda *xs: xs[int(rng.integers(len(xs)))]
    k = " data-keep=1"

    def links(n):
        return "<ul>" + "".join(f"<li><a href=x>{some(int(rng.integers(1, 4)))}</a></li>" for _ in range(n)) + "</ul>"

    def paragraph(n):
        return pick(
            f"<p{k}>{some(n)}</p>",
            f"<p{k}>{some(n)}</p>",
            f"<p{k}><b{k}>{some(n)}<br{k}><p{k}>{some(n)}</p>",
            f"<p{k}>{some(n)} <a{k} href=x>{some(2)}</a> {some(n)}</p>",
            f"<p{k}>{some(n)} <em{k}>{some(2)}</em> <span{k}>{some(1)}</span></p>",
            f"<ul{k}><li{k}>{some(n)}</li><li{k}>{some(4)}</li></ul>",
            f"<h2{k}>{some(4)}</h2>",
            f"<blockquote{k}><p{k}>{some(n)}</p></blockquote>",
            f"<pre{k}><code{k}>{some(n)}</code></pre>",
            f"<table{k}><tr{k}><th{k}>{some(2)}</th><td{k}>{some(3)}</td></tr></table>",
            f"<figure{k}><img><figcaption{k}>{some(5)}</figcaption></figure>",
            f"<div{k}>{some(n)}</div>",
            f"<section{k}><h3{k}>{some(3)}</h3><p{k}>{some(n)}</p></section>",
        )

    def aside():
        """What is no content, wherever it stands."""
        n = int(pick(2, 8, 30))
        name = pick("class", "id")
        word = pick(*pick(*[v.split() for g, v in WORDS.items() if g not in ("content", "share", "head")]))
        return pick(
            f"<div {name}='{word}'>{some(n)}</div>",
            f"<div {name}='{word}'><p>{some(n)}</p></div>",
            f"<section {name}='{word}'><h3>{some(2)}</h3><div><p>{some(n)}</p></div></section>",
            f"<aside><h3>{some(2)}</h3>{pick(links(4), f'<p>{some(n)}</p>')}</aside>",
            f"<form><label>{some(2)}</label><input><button>{some(1)}</button></form>",
            f"<form {name}='{pick('search', 'login', 'subscribe')}'><p>{some(n)}</p><button>{some(1)}</button></form>",
            f"<script>{some(n)}</script>",
            f"<style>{some(n)}</style>",
            f"<noscript>{some(n)}</noscript>",
            f"<div {name}='comments'><h3>{some(1)}</h3>"
            + "".join(f"<div class='comment'><b>{some(2)}</b><p>{some(n)}</p></div>" for _ in range(2))
            + "</div>",
            f"<ol class='commentlist'><li><p>{some(n)}</p></li></ol>",
            f"<section id='comments'><article class='comment'><p>{some(n)}</p></article></section>",
            f"<div class='share'><a>{some(1)}</a><a>{some(1)}</a></div>",
            f"<nav>{links(4)}</nav>",
        )

    pages = []
    for _ in range(count):
        inner = [f"<h1{k}>{some(5)}</h1>"] * int(rng.random() < 0.9)
        # Layouts differ in the number of paragraphs and in their length: all short, all long, or mixed.
        several = int(pick(*range(1, 9), 20, 60))
        lengths = pick((1, 3), (3, 12), (12, 40, 90), (1, 3, 12, 40, 90))
        plain = rng.random() < 0.4
        for _ in range(several):
            n = int(pick(*lengths))
            inner.append(f"<p{k}>{some(n)}</p>" if plain else paragraph(n))
            if rng.random() < min(0.2, 2 / several):
                inner.append(aside())
        body = "".join(inner)
        main = pick(
            f"<article{k}>{body}</article>",
            f"<article{k}>{body}</article>",
            f"<main{k}><article{k}>{body}</article></main>",
            f"<main{k}>{body}</main>",
            f"<div{k} class='{pick('content', 'post entry', 'article-body', 'story')}'>{body}</div>",
            f"<div id='wrap'><div{k} id='content'><div{k}>{body}</div></div>{aside()}</div>",
            f"<article{k}><header{k}><h1{k}>{some(5)}</h1></header><div{k}>{body}</div></article>",
            f"<table{k}><tr{k}><td width=9>{links(5)}</td><td{k}>{body}</td></tr></table>",
            f"<div{k}>{body}</div>",
            body,
        )
        before = pick(
            f"<nav>{links(6)}</nav>",
            f"<header><a>{some(2)}</a><nav>{links(5)}</nav></header>",
            f"<header><h1>{some(2)}</h1><p>{some(4)}</p></header>",
            f"<div class='header'><div class='logo'>{some(2)}</div></div><div id='menu'>{links(6)}</div>",
            "",
        )
        extra = ["".join(aside() for _ in range(int(rng.integers(0, 3)))) for _ in range(2)]
        after = pick(f"<footer>&copy; {some(8)}</footer>", f"<footer><p>{some(20)}</p></footer>", f"<div id='footer'>{some(9)}</div>", "")
        pages.append(
            f"<html><head><meta><title>{some(6)}</title><style>{some(2)}</style><script>{some(3)}</script></head>"
            f"<body>{before}{extra[0]}{main}{extra[1]}{after}</body></html>"
        )
    return pages


@functools.lru_cache(1)
def fitted(count: int = TRAIN_PAGES, steps: int = STEPS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(weights, pair potentials): maximum likelihood with a small penalty, by Adam; always the same."""
    pages = [Page(p) for p in labelled_pages(count, seed)]
    forest = Forest(pages)
    truth = np.array([bool(KEEP.search(r)) for p in pages for r in p.rests]).astype(int)
    weights, pairs = np.zeros(FEATURES), np.zeros((KINDS, 2, 2))
    children = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros_like(pairs)
    np.add.at(seen, (forest.kind[children], truth[forest.parent[children]], truth[children]), 1)
    state = [np.zeros(FEATURES), np.zeros(FEATURES), np.zeros_like(pairs), np.zeros_like(pairs)]
    for step in range(1, steps + 1):
        marginal, joints = forest.infer(weights, pairs)
        got = np.zeros_like(pairs)
        np.add.at(got, forest.kind[children], joints[children])
        error = (truth - marginal)[forest.rows]
        slopes = (np.bincount(forest.columns, error, FEATURES) - 0.3 * weights, seen - got - 0.3 * pairs)
        for k, (value, slope) in enumerate(zip((weights, pairs), slopes, strict=True)):
            slope = slope / len(truth) * 100
            state[2 * k] += 0.1 * (slope - state[2 * k])
            state[2 * k + 1] += 0.02 * (slope**2 - state[2 * k + 1])
            move = state[2 * k] / (1 - 0.9**step) / (np.sqrt(state[2 * k + 1] / (1 - 0.98**step)) + 1e-8)
            value += 0.1 * move
    return weights, pairs


# ---- extraction ----

FOREST_CHARS = 4 << 20


def main_texts(sources: list[str], model) -> list[str]:
    pages = [Page(s) for s in sources]
    if not pages:
        return []
    forest = Forest(pages)
    marginal, _ = forest.infer(*model)
    return [p.text(marginal[a:b] >= 0.5) for p, a, b in zip(pages, forest.starts[:-1], forest.starts[1:], strict=True)]


def extract_batches(batches, model):
    import pyarrow as pa

    for batch in batches:
        sources, texts, held, size = [s or "" for s in batch.column(2).to_pylist()], [], [], 0
        for source in sources:
            held.append(source)
            size += len(source)
            if size > FOREST_CHARS:
                texts += main_texts(held, model)
                held, size = [], 0
        texts += main_texts(held, model)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model=None
) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    Character references are decoded once, white space inside a block is one space, blocks are
    joined in page order by a line feed. Nothing else is dropped or cut. Null or empty html, and
    pages without content, give an empty text. Broken markup is read as browsers do in the common
    cases: missing end tags, stray end tags, unquoted attributes, unfinished comments. Repeated
    rows give repeated rows, null ids and urls stay null; other columns are not looked at.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    make = functools.partial(extract_batches, model=model or fitted())
    return rows.mapInArrow(make, "page_id long, url string, text string, n_chars long")
