"""The main text of web pages, by boosted trees over DOM nodes and hierarchical decoding.

A page becomes a tree of nodes: its block elements, and inline ones that have a class or an id.
Spark's boosted trees give each node the chance that its subtree holds article text. Decoding
then picks the likeliest labelling in which nothing below a dropped node is kept: from the
leaves up, a node is worth the better of dropping all of its subtree and of keeping it with the
best of each child.

The trees learn from pages of the table itself that mark their article by an `article` or
`main` element, and from pages composed of the same texts in other markups (`compose`), where
every part is known.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from hoptrail.llm.common import materialize

BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never shown as text, and controls of forms.
SILENT = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video select textarea button datalist "
    "map applet frameset noframes".split()
)
RAW = frozenset(("script", "style", "textarea", "title", "iframe", "noscript", "noframes"))
#: What can stand in a head; any other start tag and any text end it, as its end tag is optional.
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
#: Silent elements that can't hold themselves: one whose end tag isn't there before the next such
#: start tag is unclosed, and what follows is not its own.
CONTROLS = {tag: re.compile(f"<(/?){tag}(?=[\\s/>])", re.I) for tag in ("select", "button")}
#: Start tags that end an open element of the given kinds, and what bounds the search for it.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
}
_OTHER = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
_NAME = r"<(/?)([a-zA-Z][^\s/>]*+)"
_LENIENT = rf"{_NAME}([^>]*+)>|[^<]+|<"
#: A tag ends at the first `>` that isn't in quotes, or if there is none, at the first one.
_TOKEN = re.compile(rf"{_OTHER}|{_NAME}((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|{_LENIENT}", re.S)
#: Tags that may be read to the end of the page for their `>` in vain; later tags of such a page
#: end at the first `>`. So a page takes time in proportion to its length.
STRAY_QUOTES = 20
_UNQUOTED = re.compile(rf"{_OTHER}|()()()(?!)|{_LENIENT}", re.S)
#: What is left after the last `>` has no tags.
_REST = re.compile(r"<!--.*|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Attribute tokens by what they speak of. A token counts if it is one of these or begins with
#: one of them that ends in `*`.
GROUPS = [
    "article content main post entry story text prose body",
    "nav* menu* breadcrumb* pag* toc tabs skip",
    "header masthead banner top logo brand topbar",
    "foot* copyright legal colophon imprint bottom",
    "side* aside widget* rail related* recommend* trend* popular more also",
    "ad ads adv* sponsor* promo* dfp taboola outbrain commercial",
    "cookie* consent gdpr notice* alert* popup modal overlay toast banner newsletter subscri* signup paywall privacy warning",
    "comment* disqus repl* respond discuss* thread reader* feedback",
    "form search* login share* social* follow input button control* tool*",
    "hidden none invisible sr",
]
TAGS = [
    "p", "h1 h2 h3 h4 h5 h6", "li dt dd", "ul ol dl menu", "table tbody tr td th", "nav", "header", "footer", "aside",
    "form fieldset", "article main", "section", "div", "blockquote pre", "figure figcaption", "#text",
]
_TAG = {tag: i for i, tags in enumerate(TAGS) for tag in tags.split()}
ARTICLE, NAV, HEADER, FOOTER, ASIDE, FORM = (_TAG[t] for t in ("article", "nav", "header", "footer", "aside", "form"))


@dataclass
class Page:
    """Nodes in page order, a node's parent before it; pieces of text with their node."""

    parents: list[int] = field(default_factory=list)
    tags: list[str] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    #: (node, text, in a link); a None text is a break between blocks.
    pieces: list[tuple[int, str | None, bool]] = field(default_factory=list)

    def add(self, parent: int, tag: str, attributes: str) -> int:
        self.parents.append(parent)
        self.tags.append(tag)
        self.attributes.append(attributes)
        return len(self.tags) - 1


def parse(source: str | None) -> Page:
    """A lenient parse: unknown, unclosed and crossed tags make no error."""
    page = Page()
    page.add(-1, "html", "")
    # Of each open element: tag, node, and whether it or one around it is silent or a link.
    stack = [("", 0, False, False)]
    source, at = source or "", 0
    tags_end, strays = source.rfind(">"), 0
    while m := (_REST if at > tags_end else _TOKEN if strays < STRAY_QUOTES else _UNQUOTED).match(source, at):
        at = m.end()
        tag = (m[2] or m[5]) if m.re is not _REST else None
        if tag is None:
            text = m[0]
            if stack[-1][0] == "head" and not text.isspace() and (text[0] != "<" or text == "<"):
                stack.pop()
            if text[0] == "<" and text != "<":
                if text.startswith("<![CDATA[") and not stack[-1][2]:
                    page.pieces.append((stack[-1][1], text[9:-3], stack[-1][3]))
            elif not stack[-1][2]:
                page.pieces.append((stack[-1][1], html.unescape(text) if "&" in text else text, stack[-1][3]))
            continue
        strays += m[2] is None
        tag, node = tag.lower(), stack[-1][1]
        if m[1] or m[4]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    if any(x[0] in BLOCKS for x in stack[i:]):
                        page.pieces.append((node, None, False))
                    del stack[i:]
                    break
            continue
        rest = m[3] if m[2] else m[6]
        if stack[-1][0] == "head" and tag not in IN_HEAD:
            stack.pop()
            node = stack[-1][1]
        if tag in CONTROLS and not ((end := CONTROLS[tag].search(source, at)) and end[1]):
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                page.pieces.append((node, " ", False) if tag == "br" else (node, None, False))
            continue
        if tag in BLOCKS:
            page.pieces.append((node, None, False))
            kinds, bounds = ENDS.get(tag, (("p",), ("table", "button", "td", "th", "div", "li", "section", "article")))
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in kinds:
                    del stack[i:]
                    break
                if stack[i][0] in bounds:
                    break
        node, silent, link = stack[-1][1:]
        silent = silent or tag in SILENT
        attributes = ""
        if "=" in rest or "hidden" in rest:
            attributes = " ".join(f"{a} {v or ''}" if a not in ("class", "id", "role") else v for a, v in _ATTRIBUTE.findall(rest))
        if not silent and tag in ("html", "body"):
            page.attributes[0] += " " + attributes
        elif not silent and (tag in BLOCKS or attributes):
            node = page.add(node, tag, attributes)
        if not rest.endswith("/") or tag in BLOCKS:
            stack.append((tag, node, silent, link or tag == "a"))
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(source, at)
            at = end.start() if end else len(source)
    return page


def _groups(attributes: str) -> list[int]:
    tokens = {t.lower() for t in _WORD.findall(attributes)}
    if "display:none" in attributes.replace(" ", ""):
        tokens.add("hidden")
    out = []
    for group in _PATTERNS:
        out.append(sum(1 for t in tokens if group.fullmatch(t)))
    return out


_PATTERNS = [re.compile("|".join(w.replace("*", ".*") for w in g.split())) for g in GROUPS]


class Batch:
    """Flat arrays over the nodes of several pages; texts beside blocks become nodes of their own."""

    def __init__(self, pages: list[Page]):
        self.pages = pages
        parents, tags, attributes, page_of, self.piece_nodes = [], [], [], [], []
        base = 0
        for number, page in enumerate(pages):
            up, tag, attribute = list(page.parents), list(page.tags), list(page.attributes)
            has_child = set(up)
            own: dict[int, int] = {}
            nodes = []
            for node, text, _ in page.pieces:
                if text is None or not text.strip():
                    nodes.append(node)
                    if text is None:
                        own.pop(node, None)
                elif node in has_child and (node == 0 or tag[node] in BLOCKS and tag[node] not in ("p", "li", "td", "th")):
                    if node not in own:
                        own[node] = len(up)
                        up.append(node)
                        tag.append("#text")
                        attribute.append("")
                    nodes.append(own[node])
                else:
                    nodes.append(node)
            self.piece_nodes.append(np.array(nodes, np.int64) + base)
            parents += [p + base if p >= 0 else -1 for p in up]
            tags += tag
            attributes += attribute
            page_of += [number] * len(up)
            base += len(up)
        self.parents = np.array(parents, np.int64)
        self.tags = np.array([_TAG.get(t, len(TAGS)) for t in tags], np.int64)
        self.page_of = np.array(page_of, np.int64)
        self.attributes = attributes
        self.depth = np.zeros(base, np.int64)
        for i, p in enumerate(parents):
            if p >= 0:
                self.depth[i] = self.depth[p] + 1
        self.levels = [np.flatnonzero(self.depth == d) for d in range(int(self.depth.max(initial=0)) + 1)]

    def up(self, values: np.ndarray) -> np.ndarray:
        """Of each node the sum over its subtree."""
        out = values.astype(float).copy()
        for level in self.levels[:0:-1]:
            np.add.at(out, self.parents[level], out[level])
        return out

    def down(self, values: np.ndarray) -> np.ndarray:
        """Of each node the largest of the nodes above it."""
        out = np.zeros_like(values)
        for level in self.levels[1:]:
            p = self.parents[level]
            out[level] = np.maximum(out[p], values[p])
        return out

    def features(self) -> np.ndarray:
        n = len(self.parents)
        own = np.zeros((n, 5))
        order = np.zeros(n)
        for page, nodes in zip(self.pages, self.piece_nodes, strict=True):
            total = 0
            for (_, text, link), node in zip(page.pieces, nodes.tolist(), strict=True):
                if text and (size := len(text.strip())):
                    order[node] = order[node] or total + 1
                    total += size
                    own[node] += (size, size * link, text.count(" ") + 1, text.count(".") + text.count(",") + text.count("?"), 1)
        known: dict[str, list[int]] = {}
        for a in self.attributes:
            if a not in known:
                known[a] = _groups(a)
        groups = np.array([known[a] for a in self.attributes], float).reshape(n, len(GROUPS))
        one_hot = np.zeros((n, len(TAGS) + 1))
        one_hot[np.arange(n), self.tags] = 1
        chars, links, words, marks, runs = (self.up(own[:, i]) for i in range(5))
        tags = self.up(np.ones(n))
        paragraphs, items = self.up(self.tags == _TAG["p"]), self.up(self.tags == _TAG["li"])
        parent = np.where(self.parents >= 0, self.parents, np.arange(n))
        root = np.flatnonzero(self.parents < 0)
        whole = chars[root][self.page_of]
        children = np.bincount(parent[self.parents >= 0], minlength=n)
        index = np.zeros(n)
        seen = np.zeros(n)
        for i, p in enumerate(self.parents):
            if p >= 0:
                index[i] = seen[p]
                seen[p] += 1
        density = links / np.maximum(chars, 1)
        siblings = np.maximum(children[parent] - 1, 1)
        sibling_density = (np.bincount(parent, density, n)[parent] - density) / siblings
        sibling_chars = (np.bincount(parent, chars, n)[parent] - chars) / siblings
        start = np.where(order > 0, order, np.inf)
        for level in self.levels[:0:-1]:
            np.minimum.at(start, self.parents[level], start[level])
        start = np.where(np.isfinite(start), start, whole) / np.maximum(whole, 1)
        numbers = np.column_stack(
            [
                np.log1p(chars), density, np.log1p(words), marks / np.maximum(words, 1), words / np.maximum(runs, 1), tags,
                chars / tags, np.log1p(paragraphs), np.log1p(items), self.depth, children, index / np.maximum(siblings, 1),
                children[parent], sibling_density, np.log1p(sibling_chars), chars / np.maximum(whole, 1),
                chars / np.maximum(chars[parent], 1), start, density[parent],
            ]
        )
        above = np.column_stack([self.down(groups[:, i]) for i in range(len(GROUPS))])
        inside = np.column_stack([self.down(one_hot[:, t]) for t in (ARTICLE, NAV, HEADER, FOOTER, ASIDE, FORM)])
        has_article = self.up(self.tags == ARTICLE) > 0
        page_has = has_article[root][self.page_of]
        return np.column_stack([numbers, groups, above, one_hot, inside, has_article, page_has]).astype(float)

    def keep(self, chance: np.ndarray) -> np.ndarray:
        """The likeliest labels without a kept node below a dropped one."""
        chance = np.clip(chance, 1e-6, 1 - 1e-6)
        drop = self.up(np.log(1 - chance))
        best = np.log(chance)
        kept = np.zeros(len(chance), bool)
        for level in self.levels[::-1]:
            # All children of the level have added their best.
            kept[level] = best[level] >= drop[level]
            worth = np.maximum(best[level], drop[level])
            inner = self.parents[level] >= 0
            np.add.at(best, self.parents[level][inner], worth[inner])
        for level in self.levels[1:]:
            kept[level] &= kept[self.parents[level]]
        return kept

    def texts(self, kept: np.ndarray) -> list[str]:
        out = []
        for page, nodes in zip(self.pages, self.piece_nodes, strict=True):
            blocks, current = [], []
            for (_, text, _), ok in zip(page.pieces, kept[nodes].tolist(), strict=True):
                if text is None:
                    blocks.append("".join(current))
                    current = []
                elif ok:
                    current.append(text)
            blocks.append("".join(current))
            out.append(" ".join(w for b in blocks for w in b.split()))
        return out


class Trees:
    """Boosted trees as arrays, read from a fitted model's description."""

    def __init__(self, description: str):
        self.trees = []
        for part in re.split(r"\n\s*Tree \d+ ", description)[1:]:
            weight = float(re.match(r"\(weight ([-0-9.E]+)\)", part)[1])
            lines = [x.strip() for x in part.split("\n")[1:] if x.strip()]
            nodes: list[list[float]] = []
            self._read(lines, nodes)
            self.trees.append((weight, np.array(nodes)))

    def _read(self, lines: list[str], nodes: list[list[float]]) -> int:
        """Append the subtree that comes next: rows (feature, threshold, left, right, prediction)."""
        line = lines.pop(0)
        me = len(nodes)
        if line.startswith("Predict:"):
            nodes.append([-1, 0, 0, 0, float(line.split(":")[1])])
            return me
        m = re.match(r"If \(feature (\d+) <= ([-0-9.E]+)\)", line)
        nodes.append([float(m[1]), float(m[2]), 0, 0, 0])
        nodes[me][2] = self._read(lines, nodes)
        lines.pop(0)  # Else
        nodes[me][3] = self._read(lines, nodes)
        return me

    def chance(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for weight, nodes in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := np.flatnonzero(nodes[at, 0] >= 0)).size:
                here = nodes[at[inner]]
                left = x[inner, here[:, 0].astype(int)] <= here[:, 1]
                at[inner] = np.where(left, here[:, 2], here[:, 3]).astype(int)
            total += weight * nodes[at, 4]
        return 1 / (1 + np.exp(-2 * total))


def _labels(batch: Batch) -> np.ndarray:
    """For pages with an article: whether a node's subtree has text of it that isn't boilerplate."""
    n = len(batch.parents)
    groups = np.array([_groups(a) for a in batch.attributes]).reshape(n, len(GROUPS))
    bad = np.isin(batch.tags, (NAV, FOOTER, ASIDE, FORM)) | (groups[:, [1, 4, 5, 6, 7, 8, 9]].sum(1) > 0)
    good = (batch.tags == ARTICLE) | (batch.down((batch.tags == ARTICLE).astype(float)) > 0)
    content = good & ~bad & ~(batch.down(bad.astype(float)) > 0)
    has_text = np.zeros(n, bool)
    for page, nodes in zip(batch.pages, batch.piece_nodes, strict=True):
        for (_, text, _), node in zip(page.pieces, nodes.tolist(), strict=True):
            has_text[node] |= bool(text and text.strip())
    return batch.up(content & has_text) > 0


#: Markups of the parts of a composed page; `%` stands for the text's own markup.
_PARTS = {
    "menu": ['<nav>%</nav>', '<div class="menu">%</div>', '<div id="nav">%</div>', '<ul class="navbar">%</ul>', '<div class="breadcrumbs">%</div>', '<div role="navigation">%</div>'],
    "header": ['<header>%</header>', '<div class="header">%</div>', '<div id="masthead">%</div>', '<div class="site-header top">%</div>', '<div role="banner">%</div>'],
    "footer": ['<footer>%</footer>', '<div class="footer">%</div>', '<div id="footer">%</div>', '<div class="copyright">%</div>', '<p class="legal">%</p>', '<div role="contentinfo" class="site-footer">%</div>'],
    "sidebar": ['<aside>%</aside>', '<div class="sidebar">%</div>', '<div id="side">%</div>', '<section class="related">%</section>', '<div class="widget">%</div>', '<div class="recommended">%</div>', '<div role="complementary">%</div>'],
    "notice": ['<div class="cookie-notice">%</div>', '<div id="consent">%</div>', '<div class="alert">%</div>', '<div class="newsletter">%</div>', '<div role="alert">%</div>', '<section class="notice">%</section>', '<p class="notice">%</p>', '<div class="banner cookie">%</div>'],
    "advert": ['<div class="ad">%</div>', '<div class="ads banner">%</div>', '<div id="sponsor">%</div>', '<div class="advert">%</div>', '<p class="ad">%</p>', '<section class="promo">%</section>', '<aside class="sponsored">%</aside>'],
    "comments": ['<section class="comments">%</section>', '<div id="comments">%</div>', '<div class="comment-list">%</div>', '<ol class="commentlist">%</ol>', '<div class="replies">%</div>', '<div id="disqus_thread">%</div>'],
    "form": ['<form>%</form>', '<form class="search">%</form>', '<div class="share">%</div>', '<div class="login">%</div>', '<form id="signup"><label>%</label></form>'],
}
_MAIN = ['<article>%</article>', '<main>%</main>', '<div class="content">%</div>', '<div id="main">%</div>', '<div class="post">%</div>', '<div class="entry-content">%</div>', '<section class="story">%</section>', '<div class="article-body">%</div>', '<div>%</div>', '<main><article>%</article></main>', '<div class="page"><div class="text">%</div></div>']
MARK = "\x02"


def compose(paragraphs: list[str], rng: random.Random) -> str:
    """A page in which every piece of article text begins with `MARK`."""
    words = " ".join(paragraphs).split() or ["word"]
    some = lambda a, b: html.escape(" ".join(rng.choice(words) for _ in range(rng.randint(a, b))))
    real = lambda: html.escape(rng.choice(paragraphs)) if paragraphs else some(5, 40)

    def links(a: int, b: int) -> str:
        return "".join(f'<li><a href="/{i}">{some(1, 3)}</a></li>' for i in range(rng.randint(a, b)))

    def part(kind: str) -> str:
        inner = {
            "menu": lambda: rng.choice((f"<ul>{links(2, 8)}</ul>", " | ".join(f"<a href='#'>{some(1, 2)}</a>" for _ in range(rng.randint(2, 6))))),
            "header": lambda: rng.choice((f"<a href='/'>{some(1, 3)}</a>", f"<h1>{some(1, 3)}</h1>", f"<p>{some(2, 9)}</p>", f"<div class='logo'>{some(1, 2)}</div><p>{some(2, 8)}</p>")),
            "footer": lambda: rng.choice((f"&copy; {some(1, 3)} &middot; {real()}", f"<p>{some(3, 15)}</p>", f"<ul>{links(2, 6)}</ul>", f"<p>&copy; {some(1, 4)}</p><p>{real()}</p>")),
            "sidebar": lambda: rng.choice((f"<h3>{some(1, 3)}</h3><ul>{links(2, 8)}</ul>", f"<p>{real()}</p>", f"<h2>{some(1, 4)}</h2><p>{real()}</p><p>{some(4, 30)}</p>", real())),
            "notice": lambda: rng.choice((f"<p>{some(4, 25)}</p>", some(4, 25), f"{real()} <a href='#'>{some(1, 2)}</a>", f"<p>{real()}</p>")),
            "advert": lambda: rng.choice((some(3, 15), real(), f"<a href='#'>{some(3, 12)}</a>", f"<p>{real()}</p>")),
            "comments": lambda: "".join(
                rng.choice((f"<div class='comment'><b>{some(1, 2)}</b><p>{{}}</p></div>", "<li><p>{}</p></li>", "<p>{}</p>", "<article class='comment'><p>{}</p></article>")).format(rng.choice((some(3, 40), real())).replace("{", "").replace("}", ""))
                for _ in range(rng.randint(1, 5))
            ),
            "form": lambda: rng.choice((f"<label>{some(1, 4)}</label><input name='q'><button>{some(1, 2)}</button>", f"<a href='#'>{some(1, 2)}</a> <a href='#'>{some(1, 2)}</a>", f"<p>{some(2, 8)}</p><input>")),
        }[kind]()
        # A paragraph holds no other block.
        outer = [x for x in _PARTS[kind] if not (x.startswith("<p") and re.search("<(p|ul|h[1-6]|div|li)", inner))]
        return rng.choice(outer).replace("%", inner)

    def block() -> str:
        text = MARK + rng.choice((real, lambda: some(1, 12), lambda: some(20, 80)))()
        shape = rng.random()
        if shape < 0.6:
            return f"<p>{text}</p>"
        if shape < 0.7:
            return f"<p><b>{text}<br><p>{MARK}{real()}</p>"
        if shape < 0.8:
            return f"<h2>{text}</h2>"
        if shape < 0.86:
            return "<ul>" + "".join(f"<li>{MARK}{some(2, 15)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>"
        if shape < 0.9:
            return f"<blockquote><p>{text}</p></blockquote>"
        if shape < 0.93:
            return f"<table><tr><td>{text}</td><td>{MARK}{some(1, 3)}</td></tr></table>"
        if shape < 0.96:
            return f"<div>{text}</div>"
        return f"<p>{text} <a href='#'>{some(1, 4)}</a> {some(2, 9)}</p>"

    blocks = [block() for _ in range(rng.choice((1, 2, 3, 5, 8, 12, 20)))]
    title = f"<h1>{MARK}{some(1, 12)}</h1>"
    if rng.random() < 0.2:
        title = f"<header>{title}</header>"
    if rng.random() < 0.85:
        blocks.insert(0, title)
    for kind in rng.sample(["advert", "form", "comments", "notice", "sidebar"], rng.choice((0, 0, 0, 1, 2))):
        blocks.insert(len(blocks) if kind == "comments" else rng.randint(1, len(blocks)), part(kind))
    before = [part(k) for k in ("header", "menu", "notice", "advert") if rng.random() < 0.55]
    after = [part(k) for k in ("sidebar", "comments", "advert", "form", "notice", "footer") if rng.random() < 0.4]
    rng.shuffle(before)
    if rng.random() < 0.2:
        before.append(part("sidebar"))
    body = "".join(before) + rng.choice(_MAIN).replace("%", "".join(blocks)) + "".join(after)
    if rng.random() < 0.3:
        body = f"<div class='{rng.choice(('wrapper', 'container', 'page', 'site'))}'>{body}</div>"
    return f"<html><head><title>{some(1, 9)}</title></head><body>{body}</body></html>"


def _composed_labels(batch: Batch) -> np.ndarray:
    marked = np.zeros(len(batch.parents))
    for page, nodes in zip(batch.pages, batch.piece_nodes, strict=True):
        for (_, text, _), node in zip(page.pieces, nodes.tolist(), strict=True):
            if text and MARK in text:
                marked[node] = 1
    return batch.up(marked) > 0


def _examples(source: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a page's nodes (if it marks its article) and of three composed ones."""
    page = parse(source)
    paragraphs = [" ".join(t.split()) for _, t, link in page.pieces if t and len(t.split()) > 3 and not link]
    # The same page gives the same compositions, whichever task reads it.
    rng = random.Random(source)
    composed = [parse(compose(paragraphs, rng)) for _ in range(3)]
    made = Batch(composed)
    labels = _composed_labels(made)
    for p in composed:
        p.pieces = [(n, t.replace(MARK, "") if t else t, link) for n, t, link in p.pieces]
    x, y = [made.features()], [labels]
    if any(t in ("article", "main") for t in page.tags):
        own = Batch([page])
        x.append(own.features())
        y.append(_labels(own))
    return np.concatenate(x), np.concatenate(y)


def fit(pages: DataFrame, source: str = "html", sample: int = 400, rounds: int = 20, depth: int = 5) -> Trees | None:
    """Trees from at most about `sample` different pages, picked by a hash of their source. None without pages."""
    rows = pages.select(F.col(f"`{source}`").alias("html")).filter(F.col("html").isNotNull())
    place = F.pmod(F.xxhash64("html"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    different = rows.select(F.xxhash64("html").alias("mark")).distinct().count()
    rows = rows.filter(place < min(1.0, sample / max(1, different))).distinct()

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column("html").to_pylist():
                x, y = _examples(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(y.astype(float))], ["x", "y"]
                )

    data = materialize(rows.mapInArrow(examples, "x array<double>, y double"))
    if data.select("y").distinct().count() < 2:
        return None
    trees = GBTClassifier(featuresCol="features", labelCol="y", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=7)
    return Trees(trees.fit(data.select(array_to_vector("x").alias("features"), "y")).toDebugString)


def extract(df: DataFrame, trees: Trees | None, source: str = "html", out: str = "text") -> DataFrame:
    """`df` with `out`, the main text of each page.

    Null and empty pages, and pages without article text, have the empty text. Character
    references are decoded; white space inside a block becomes one space; blocks are joined by one
    space in page order. Pages are read whole, and nothing of the kept nodes is dropped. Rows
    stay, equal ones alike; a column of the name `out` is replaced. Without trees (no page to
    learn from) all text is kept.
    """
    shared = df.sparkSession.sparkContext.broadcast(trees)

    @F.arrow_udf(StringType())
    def main_text(sources: pa.Array) -> pa.Array:
        texts: list[str] = []
        values = sources.to_pylist()
        for i in range(0, len(values), 64):
            batch = Batch([parse(v) for v in values[i : i + 64]])
            if shared.value is None:
                kept = np.ones(len(batch.parents), bool)
            else:
                kept = batch.keep(shared.value.chance(batch.features()))
            texts += batch.texts(kept)
        return pa.array(texts, pa.string())

    return df.withColumn(out, main_text(F.col(f"`{source}`")))
