"""Main text of web pages from a tree-structured graphical model over DOM nodes.

Every block element is a node with a hidden label, content or not. A node's own
features give its potential, and each parent-child edge one for the pair of
labels. Sum-product messages go up from the leaves and down from the root, so
each node's marginal takes the whole page into account. The potentials are
trained by exact gradients on labelled pages, which are written by rule from
layouts of common parts; nothing is taken from the pages that are read. Names of
classes are one kind of evidence among others (how much of the page's text and of
its links a node holds, prose, where it stands to the main heading), and a share of
the labelled pages has names that say nothing or the wrong thing.

Pages are independent: a batch of them is one forest, and messages of all its
nodes of one depth are computed together.
"""

from __future__ import annotations

import html as html_entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names by the role that HTML gives them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template iframe svg select".split())
#: What may stand in a head; anything else ends it.
HEAD = frozenset("head base basefont bgsound link meta noframes noscript script style template title".split())
#: Parts of a formula, which are one text; here "/>" closes.
MATH = frozenset(
    "annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot "
    "mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var wbr".split()
) | MATH
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
CLOSED_BY_OWN_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: What a drawing cannot hold; it ends there if its end tag is missing.
ENDS_SVG = CLOSES_P | (INLINE - MATH - {"a"}) | frozenset("body li dt dd tr td th tbody thead caption noscript object math form button input".split())
SCOPES = frozenset("html body table ul ol dl div article section main aside nav td th form".split())

TAG_GROUPS = (
    "article main", "nav menu", "header", "footer", "aside", "form fieldset button input", "p", "h1 h2 h3 h4 h5 h6", "li ul ol dl dt dd",
    "div", "section", "table tbody thead tr td th", "blockquote pre figure figcaption", "html body",
)
WORD_GROUPS = (
    "nav menu navbar navigation breadcrumb breadcrumbs pagination pager tabs toc",
    "header masthead topbar banner logo hero",
    "footer foot copyright legal colophon",
    "sidebar side aside rail widget widgets related recommended recommend more popular trending",
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion outbrain taboola",
    "cookie cookies consent notice notices gdpr popup modal overlay alert message newsletter subscribe signup paywall",
    "comment comments reply replies respond disqus discussion thread responses",
    "share sharing social follow login search form",
    "article content post entry story text body main page prose",
    "meta byline author date tags category info",
)
_TAG_GROUP = {tag: i for i, group in enumerate(TAG_GROUPS) for tag in group.split()}
_WORD_GROUP = {word: i for i, group in enumerate(WORD_GROUPS) for word in group.split()}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<loose>[a-zA-Z][^\s/>]*)(?P<loose_attrs>[^>]*)(?:>|\Z)",
    re.S,
)
_MARKING = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_LABEL = re.compile(r'data-label="([01])"')
_WORD = re.compile(r"[a-z]+")
_IN_SVG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}


@dataclass
class Page:
    """The tree of one page: a node per block element, in page order."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    depths: list[int] = field(default_factory=list)
    words: list[tuple[int, ...]] = field(default_factory=list)
    labels: list[int] = field(default_factory=list)
    #: per block of text: node, text, characters inside links
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


def _clean(text: str) -> str:
    return " ".join(html_entities.unescape(text).split())


def parse(source: str) -> Page:
    """Tree and text blocks; tolerates what is unclosed, misnested or cut off."""
    page = Page()
    stack: list[tuple[str, int]] = []  # open elements and the node that each belongs to
    places: dict[str, list[int]] = {}  # of each tag, where it stands in the stack
    buffer: list[str] = []
    link_chars, in_link, hidden = 0, 0, 0

    def node_of_top() -> int:
        return stack[-1][1] if stack else -1

    def flush() -> None:
        nonlocal link_chars
        if buffer:
            text = _clean("".join(buffer))
            if text and not hidden:
                page.blocks.append((max(node_of_top(), 0), text, link_chars))
            buffer.clear()
        link_chars = 0

    def add_node(tag: str, attrs: str) -> int:
        parent = node_of_top()
        page.tags.append(tag)
        page.parents.append(parent)
        page.depths.append(page.depths[parent] + 1 if parent >= 0 else 0)
        found: tuple[int, ...] = ()
        if attrs:
            named = " ".join(part for m in _MARKING.finditer(attrs) for part in m.groups() if part).lower()
            found = tuple(sorted({_WORD_GROUP[w] for w in _WORD.findall(named) if w in _WORD_GROUP}))
        page.words.append(found)
        label = _LABEL.search(attrs) if attrs else None
        page.labels.append(int(label[1]) if label else -1)
        return len(page.tags) - 1

    def push(tag: str, node: int) -> None:
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, node))

    def last(names: set[str] | frozenset[str]) -> int:
        return max((places[name][-1] for name in names if places.get(name)), default=-1)

    def close(until: int) -> None:
        nonlocal in_link, hidden
        flush_needed = any(tag not in INLINE for tag, _ in stack[until:])
        if flush_needed:
            flush()
        for tag, _ in stack[until:]:
            places[tag].pop()
            in_link -= tag == "a"
            hidden -= tag == "head"
        del stack[until:]

    def close_nearest(names: set[str] | frozenset[str], scopes: frozenset[str]) -> None:
        at = last(names)
        if at >= 0 and at >= last(scopes):
            close(at)

    def end_of_svg(at: int) -> int:
        """Behind the end tag, or before what a drawing cannot hold."""
        foreign = 0
        for m in _IN_SVG.finditer(source, at):
            name = m[2].lower()
            if name == "foreignobject":
                foreign += -1 if m[1] else 1
            elif m[1] and name == "svg":
                closing = source.find(">", m.end())
                return closing + 1 if closing >= 0 else len(source)
            elif not foreign and (places.get(name) if m[1] else name in ENDS_SVG):
                return m.start()
        return len(source)

    add_node("html", "")
    push("html", 0)
    at, size = 0, len(source)
    while at < size:
        mark = source.find("<", at)
        token = _TOKEN.match(source, mark) if mark >= 0 else None
        end = mark if mark >= 0 else size
        if mark >= 0 and token is None:
            end = mark + 1
        if end > at:
            text = source[at:end]
            if hidden and not text.isspace():
                close_nearest({"head"}, frozenset())
            buffer.append(text)
            link_chars += len(text) * (in_link > 0)
        if token is None:
            at = end
            continue
        at = token.end()
        start = token["start"] or token["loose"]
        if start:
            tag = start.lower()
            attrs = token["attrs"] or token["loose_attrs"] or ""
            closed = attrs.rstrip().endswith("/")
            if hidden and tag not in HEAD and tag != "html":
                close_nearest({"head"}, frozenset())
            if tag == "svg" and closed:
                continue
            if tag == "svg":
                at = end_of_svg(at)
                buffer.append(" ")
                continue
            if tag in RAW:
                closing = _RAW_END[tag].search(source, at)
                at = closing.end() if closing else size
                buffer.append(" ")
                continue
            if tag in INLINE:
                if tag in ("br", "img", "wbr"):
                    buffer.append(" ")
                elif not (closed and tag in MATH):
                    push(tag, node_of_top())
                    in_link += tag == "a"
                continue
            flush()
            if tag in CLOSES_P:
                close_nearest({"p"}, SCOPES)
            if tag in CLOSED_BY_OWN_KIND:
                close_nearest(CLOSED_BY_OWN_KIND[tag], SCOPES - CLOSED_BY_OWN_KIND[tag])
            if tag == "html":
                continue
            node = add_node(tag, attrs)
            if tag not in VOID and not closed:
                push(tag, node)
                hidden += tag == "head"
        elif token["end"]:
            tag = token["end"].lower()
            if tag == "br":
                buffer.append(" ")
            elif tag not in ("html", "body") and places.get(tag):
                close(places[tag][-1])
    flush()
    return page


_N_TAGS, _N_WORDS = len(TAG_GROUPS), len(WORD_GROUPS)
_N_OWN, _N_PLACE = 7, 16
N_FEATURES = 1 + _N_TAGS + 1 + _N_WORDS + _N_OWN + _N_PLACE
#: A block of prose: long enough, ends like a sentence, not mostly a link.
PROSE_CHARS = 60


def _below(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums over the nodes of each subtree; nodes stand in page order."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    return total[ends] - total[:-1]


def _subtree_ends(parents: list[int]) -> np.ndarray:
    sizes = [1] * len(parents)
    for i in range(len(parents) - 1, 0, -1):
        sizes[parents[i]] += sizes[i]
    return np.arange(len(parents)) + np.array(sizes)


def place_features(page: Page) -> np.ndarray:
    """What a node and all below it hold of the page, and where it stands."""
    n = len(page.tags)
    own = np.zeros((n, 4))  # characters, characters in links, blocks, characters of prose
    for node, text, linked in page.blocks:
        linked = min(linked, len(text))
        prose = len(text) >= PROSE_CHARS and text[-1] in ".!?…:;\"'”" and 2 * linked < len(text)
        own[node] += (len(text), linked, 1, len(text) * prose)
    ends = _subtree_ends(page.parents)
    below = _below(own, ends)
    chars, links, blocks, prose = below.T
    parents = np.maximum(page.parents, 0)
    share = chars / max(chars[0], 1)
    among = chars / np.maximum(chars[parents], 1)
    among_prose = prose / np.maximum(prose[parents], 1)
    before = np.concatenate([[0], np.cumsum(own[:, 0])[:-1]]) / max(chars[0], 1)
    # the main heading: the first h1 outside of links that has a text, else the first h2
    said = [i for level in ("h1", "h2") for i, tag in enumerate(page.tags) if tag == level and chars[i] > links[i]]
    frame, heading = 0, -1
    if said:
        heading = frame = said[0]
        while frame and not prose[frame]:
            frame = page.parents[frame]
    at = np.arange(n)
    has_heading = (at <= heading) & (heading < ends) if said else np.zeros(n, bool)
    in_frame = (frame <= at) & (at < ends[frame])
    whole = np.array([tag in ("article", "main") for tag in page.tags])
    inside = whole.copy()
    for i in range(1, n):
        inside[i] |= inside[page.parents[i]]
    alike: dict[tuple[int, str], int] = {}
    kinds = [(p, tag) for p, tag in zip(page.parents, page.tags)]
    for i, kind in enumerate(kinds):
        alike[kind] = alike.get(kind, 0) + (ends[i] > i + 1)
    nested = np.array([alike[kind] if ends[i] > i + 1 else 0 for i, kind in enumerate(kinds)])
    columns = (
        np.log1p(chars) / 8, links / np.maximum(chars, 1), share, among, among_prose, prose / np.maximum(chars, 1), prose > 0,
        np.log1p(chars / np.maximum(blocks, 1)) / 6, has_heading, in_frame & (frame > 0), (heading >= 0) & (at > heading), before, 1 - before - share,
        inside, inside.any() & ~inside & ~(_below(whole.astype(float), ends) > 0), np.log1p(nested) / 2,
    )
    return np.stack([np.asarray(c, float) for c in columns], axis=1)


def node_features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, parents, depths) of the forest of some pages."""
    sizes = [len(p.tags) for p in pages]
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    n = int(sum(sizes))
    x = np.zeros((n, N_FEATURES))
    x[:, 0] = 1
    parents = np.concatenate([np.where(np.array(p.parents) < 0, -1, np.array(p.parents) + b) for p, b in zip(pages, base)])
    depths = np.concatenate([np.array(p.depths) for p in pages])
    group = np.array([_TAG_GROUP.get(t, _N_TAGS) for p in pages for t in p.tags])
    x[np.arange(n), 1 + group] = 1
    first_word = 2 + _N_TAGS
    for p, b in zip(pages, base):
        for i, found in enumerate(p.words):
            for w in found:
                x[b + i, first_word + w] = 1
    chars, links, stops, blocks = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for p, b in zip(pages, base):
        for node, text, linked in p.blocks:
            chars[b + node] += len(text)
            links[b + node] += min(linked, len(text))
            stops[b + node] += text[-1] in ".!?…:;"
            blocks[b + node] += 1
    own = first_word + _N_WORDS
    x[:, own] = np.log1p(chars) / 5
    x[:, own + 1] = links / np.maximum(chars, 1)
    x[:, own + 2] = (stops > 0) & (links < chars)
    x[:, own + 3] = blocks > 0
    x[:, own + 4] = chars > 200
    # words of class or id that say content and something else at once say the latter
    says_other = x[:, first_word : first_word + 8].any(axis=1)
    x[:, own + 5] = says_other
    x[:, own + 6] = says_other & (x[:, first_word + 8] > 0)
    x[:, own + _N_OWN :] = np.concatenate([place_features(p) for p in pages])
    return x, parents, depths


def _levels(depths: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(depths, kind="stable")
    return np.split(order, np.cumsum(np.bincount(depths))[:-1])


def sum_product(score: np.ndarray, parents: np.ndarray, depths: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marginals of label 1, expected pairs of parent and child labels).

    Up: each node's evidence with that of all below it goes to its parent. Down:
    each parent sends back what it knows without the child's own message.
    """
    levels = _levels(depths)
    up = np.stack([np.zeros(len(score)), score], axis=1)
    to_parent = np.zeros_like(up)
    for level in levels[:0:-1]:
        sent = np.logaddexp(pair[:, 0][None] + up[level, 0, None], pair[:, 1][None] + up[level, 1, None])
        to_parent[level] = sent
        np.add.at(up, parents[level], sent)
    belief = up.copy()
    expected = np.zeros((2, 2))
    for level in levels[1:]:
        rest = belief[parents[level]] - to_parent[level]
        rest -= rest.max(axis=1, keepdims=True)
        joint = rest[:, :, None] + pair[None] + up[level][:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        belief[level] = up[level] + np.logaddexp(rest[:, 0, None] + pair[0], rest[:, 1, None] + pair[1])
    return np.exp(belief[:, 1] - np.logaddexp(belief[:, 0], belief[:, 1])), expected


@dataclass
class DomModel:
    weights: np.ndarray
    pair: np.ndarray

    @classmethod
    def fit(cls, pages: list[Page], steps: int = 200) -> DomModel:
        """Penalised maximum likelihood on pages whose nodes are all labelled."""
        x, parents, depths = node_features(pages)
        y = np.array([label for p in pages for label in p.labels], float)
        child = parents >= 0
        observed = np.zeros((2, 2))
        np.add.at(observed, (y[parents[child]].astype(int), y[child].astype(int)), 1)
        theta = np.zeros(N_FEATURES + 4)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            marginal, expected = sum_product(x @ theta[:-4], parents, depths, theta[-4:].reshape(2, 2))
            grad = np.concatenate([x.T @ (y - marginal), (observed - expected).ravel()]) / len(pages) - 2e-2 * theta
            m = 0.9 * m + 0.1 * grad
            v = 0.99 * v + 0.01 * grad**2
            theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return cls(theta[:-4], theta[-4:].reshape(2, 2))

    def texts(self, sources: list[str]) -> list[str]:
        pages = [parse(s) for s in sources]
        if not pages:
            return []
        x, parents, depths = node_features(pages)
        marginal, _ = sum_product(x @ self.weights, parents, depths, self.pair)
        out, base = [], 0
        for page in pages:
            out.append("\n\n".join(text for node, text, _ in page.blocks if marginal[base + node] >= 0.5))
            base += len(page.tags)
        return out


# --- labelled pages ---------------------------------------------------------------------------------------------------


def _sentence(rnd: random.Random, low: int, high: int, stop: bool = True) -> str:
    words = ["".join(rnd.choice("aeiourstlnmd") for _ in range(rnd.randint(2, 9))) for _ in range(rnd.randint(low, high))]
    return " ".join(words).capitalize() + "." * stop


def _tagged(tag: str, label: int, inner: str, marks: str = "") -> str:
    return f'<{tag} data-label="{label}"{" " + marks if marks else ""}>{inner}</{tag}>'


def _links(rnd: random.Random, label: int) -> str:
    items = "".join(_tagged("li", label, f'<a href="/{i}">{_sentence(rnd, 1, 3, False)}</a>') for i in range(rnd.randint(2, 7)))
    return _tagged("ul", label, items)


def _unknown(rnd: random.Random) -> str:
    """A name that no list holds."""
    return "".join(rnd.choice("bfghjkpqvwxyz") + rnd.choice("aeiou") for _ in range(rnd.randint(2, 4)))


def _renamed(rnd: random.Random, page: str, share: float) -> str:
    """The page with a share of its class names and ids replaced by unknown ones."""
    return re.sub(r'(class|id)="[^"]*"', lambda m: f'{m[1]}="{_unknown(rnd)}"' if rnd.random() < share else m[0], page)


def _other_part(rnd: random.Random) -> str:
    """A part of a page that is not its article."""
    kind = rnd.choice(["nav", "header", "footer", "side", "ad", "notice", "comments", "form", "share"])
    words = WORD_GROUPS[{"nav": 0, "header": 1, "footer": 2, "side": 3, "ad": 4, "notice": 5, "comments": 6, "form": 7, "share": 7}[kind]].split()
    own_tag = {"nav": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form"}.get(kind)
    tag = own_tag if own_tag and rnd.random() < 0.6 else rnd.choice(["div", "section", "div", "aside" if kind in ("side", "ad") else "div"])
    marks = f'{rnd.choice(["class", "id"])}="{rnd.choice(words)}"' if tag != own_tag or rnd.random() < 0.4 else ""
    style = rnd.random()
    if kind == "nav" or style < 0.25 and kind != "comments":
        inner = _links(rnd, 0)
    elif kind == "comments":
        inner = "".join(
            _tagged("div", 0, _tagged("p", 0, _sentence(rnd, 3, 40)), 'class="comment"' * (rnd.random() < 0.7)) for _ in range(rnd.randint(1, 4))
        )
        if rnd.random() < 0.5:
            inner = _tagged(rnd.choice(["h2", "h3", "h4"]), 0, _sentence(rnd, 1, 3, False)) + inner
    elif style < 0.6:
        inner = _sentence(rnd, 2, 25, rnd.random() < 0.7)
    else:
        inner = _tagged("p", 0, _sentence(rnd, 2, 30, rnd.random() < 0.7))
    return _tagged(tag, 0, inner, marks)


def _article(rnd: random.Random) -> str:
    blocks = [_tagged(rnd.choice(["h1", "h1", "h2"]), 1, _sentence(rnd, 2, 9, rnd.random() < 0.3))]
    for _ in range(rnd.choice([0, 1, 2, 4, 8])):
        r = rnd.random()
        if r < 0.75:
            blocks.append(_tagged("p", 1, _sentence(rnd, 2 if rnd.random() < 0.3 else 12, 60, rnd.random() < 0.9)))
        elif r < 0.83:
            blocks.append(_tagged("ul", 1, "".join(_tagged("li", 1, _sentence(rnd, 2, 14)) for _ in range(rnd.randint(2, 4)))))
        elif r < 0.9:
            blocks.append(_tagged(rnd.choice(["blockquote", "pre"]), 1, _sentence(rnd, 4, 30)))
        elif r < 0.93:
            blocks.append(_tagged(rnd.choice(["h2", "h3"]), 1, _sentence(rnd, 1, 6, False)))
        elif r < 0.95:
            blocks.append(_links(rnd, 1))
        elif r < 0.98:
            # a part of the article under a name that says something else, or nothing
            inner = "".join(_tagged("p", 1, _sentence(rnd, 12, 60)) for _ in range(rnd.randint(1, 3)))
            name = rnd.choice([_unknown(rnd), rnd.choice(rnd.choice(WORD_GROUPS[3:8]).split())])
            blocks.append(_tagged(rnd.choice(["div", "section"]), 1, inner, f'class="{name}{rnd.choice(["", "-text", "-body"])}"'))
        else:
            row = _tagged("tr", 1, "".join(_tagged("td", 1, _sentence(rnd, 1, 3, False)) for _ in range(3)))
            blocks.append(_tagged("table", 1, row + row))
    if len(blocks) > 1 and rnd.random() < 0.25:  # something foreign inside the article
        blocks.insert(rnd.randint(1, len(blocks)), _other_part(rnd))
    tag = rnd.choice(["article", "article", "main", "div", "section"])
    words = WORD_GROUPS[8].split()
    marks = f'{rnd.choice(["class", "id"])}="{rnd.choice(words)}"' if tag in ("div", "section") or rnd.random() < 0.3 else ""
    return _tagged(tag, 1, "".join(blocks), marks)


def labelled_pages(n: int = 600, seed: int = 7) -> list[Page]:
    """Pages of an article among other parts, every node labelled; the frame
    around an article counts as content."""
    rnd = random.Random(seed)
    pages = []
    for _ in range(n):
        parts = [_other_part(rnd) for _ in range(rnd.randint(1, 4))]
        after = [_other_part(rnd) for _ in range(rnd.randint(0, 3))]
        middle = _article(rnd)
        if rnd.random() < 0.3:
            middle = _tagged("div", 1, middle + (_other_part(rnd) if rnd.random() < 0.5 else ""), rnd.choice(["", 'class="page"', 'id="main"', 'class="wrap"']))
        body = f'{"".join(parts)}{middle}{"".join(after)}'
        body = _renamed(rnd, body, rnd.choice([0, 0, 0.3, 1]))
        page = parse(f'<html><body data-label="1">{body}</body></html>')
        page.labels[0] = 1
        pages.append(page)
    return pages


@lru_cache(maxsize=1)
def trained_model() -> DomModel:
    return DomModel.fit(labelled_pages())


def extract_text(
    pages: DataFrame, model: DomModel | None = None, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars of every row.

    Row-local. Defined cases: a null or empty html gives an empty text; ids and
    urls may be null and pass as they are; repeated rows are read each; an empty
    table gives no rows; other columns are dropped. Markup that is unclosed, cut
    off or very deep is read as far as it goes.
    """
    fitted = model or trained_model()

    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            sources = [source or "" for source in batch]
            out: list[str] = []
            for lo in range(0, len(sources), 64):
                out += fitted.texts(sources[lo : lo + 64])
            yield pd.Series(out, dtype=object)

    text = F.pandas_udf(extracted, "string")
    return pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text(F.coalesce(F.col(html_col), F.lit(""))).alias("text")
    ).withColumn("n_chars", F.length("text").cast("bigint"))
