"""Main text of web pages: a tree-structured graphical model over the DOM, decided by sum-product messages."""

from __future__ import annotations

import html as entities
import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import read_table, small_batches
from .registry import query

PAGES_AT_ONCE = 200
CHARS_AT_ONCE = 1 << 22  # of markup whose trees are held together; a longer page is held alone
TRAINING_PAGES = 600    # labelled pages that the rule below writes

# Element names by their role in the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time "
             "tt u var wbr br img picture source nobr".split())
HIDDEN = set("script style noscript template head title iframe object svg math canvas audio video select option datalist textarea button".split())
RAW = set("script style noscript template title iframe textarea".split())
#: Elements that can stand in the head; any other one ends it.
HEAD = set("html head title base basefont bgsound link meta noframes noscript script style template".split())
#: Starting one of these ends an open paragraph.
ENDS_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
             "main menu nav ol p pre search section summary table ul".split())
#: An open paragraph outside of these goes on inside them.
WALLS_OF_P = ("table", "td", "th", "button", "object")
#: An element ended by the start of one of its own group, up to the given containers.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
            "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Starting one of these ends a hidden element that the page never closes.
ENDS_HIDDEN = (ENDS_P | set(SIBLINGS) | {"body"}) - {"hr"}
UNCLOSED = -2

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|[^<]+|<""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|data-y)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)

_TAGS = ["p", "h1", "h2", "h3", "li", "ul", "ol", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "table", "td", "blockquote",
         "pre", "figure", "figcaption", "body", "html", "fieldset", "menu", "dl", "address", "dialog", "tr", "article header", "other article"]
_CUES = {
    "good": r"article|content|post|entry|main|story|body|text|prose",
    "menu": r"nav|menu|breadcrumb|pagination|toc|skip",
    "edge": r"foot|header|masthead|logo|copyright|legal|top-?bar|banner",
    "side": r"side|aside|widget|related|recommend|popular|more-",
    "ad": r"(?:^|[\s_-])ads?(?:$|[\s_-])|advert|sponsor|promo|affiliate",
    "notice": r"cookie|consent|notice|alert|gdpr|popup|modal|overlay|subscribe|newsletter|paywall|disclaimer",
    "form": r"form|login|signup|search",
    "talk": r"comment|repl(?:y|ies)|discuss|reaction|disqus|respond",
    "share": r"share|social|follow|tags?(?:$|[\s_-])|author|byline|meta",
}
_CUE_PATTERNS = [re.compile(p) for p in _CUES.values()]
N_ELEMENT = len(_TAGS) + len(_CUES) + 1
#: Word counts from which a text block is of the next step of length.
LENGTHS = (4, 10, 25)
#: Features of text blocks: bias, share of linked words in steps, length in steps, whether it ends like a sentence.
N_TEXT = 5 + len(LENGTHS) + 1
SENTENCE_ENDS = ".!?:\"\u201d\u3002"
#: States of a node: outside of either, main text, and what is around it.
NEUTRAL, CONTENT, CLUTTER = 0, 1, 2
STATES = 3


def closed_starts(page: str, tag: str) -> set[int]:
    """Where the elements of a name start that have an end tag of their own; comments and scripts do not count."""
    waiting, closed = [], set()
    for m in re.finditer(rf"<!--.*?(?:-->|\Z)|<script\b.*?(?:</script|\Z)|<(/?){tag}(?=[\s/>])", page, re.I | re.S):
        if m[1] is None:
            continue
        if not m[1]:
            waiting.append(m.start())
        elif waiting:
            closed.add(waiting.pop())
    return closed


@dataclass
class Dom:
    """Elements and text blocks in page order; a text block is a leaf."""

    parent: list[int] = field(default_factory=list)
    leaf: list[bool] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    label: list[int] = field(default_factory=list)


def parse(page: str, dom: Dom | None = None, labelled: bool = False) -> Dom:
    """The page's block elements and, as leaves, its runs of text between block boundaries. Unclosed and stray tags are repaired."""
    dom = dom or Dom()
    stack: list[tuple[str, int]] = []   # open elements; -1 for inline and hidden ones, UNCLOSED for hidden ones without an end tag
    places: dict[str, list[int]] = {}   # where in the stack the open elements of a name are
    blocks: list[int] = []              # the nodes of open block elements
    loose: list[int] = []               # where in the stack the UNCLOSED ones are
    closed: dict[str, set[int]] = {}
    pieces: list[str] = []
    linked = anchors = hidden = 0

    def node(leaf, tag, attributes, text, n_linked, label):
        parent = blocks[-1] if blocks else -1
        for column, value in ((dom.parent, parent), (dom.leaf, leaf), (dom.tag, tag), (dom.attributes, attributes), (dom.text, text),
                              (dom.linked, n_linked), (dom.label, label if label is not None else (dom.label[parent] if parent >= 0 else 0))):
            column.append(value)
        return len(dom.parent) - 1

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                node(True, "", "", text, linked, None)
            pieces.clear()
        linked = 0

    def push(tag, index):
        places.setdefault(tag, []).append(len(stack))
        if index >= 0:
            blocks.append(index)
        elif index == UNCLOSED:
            loose.append(len(stack))
        stack.append((tag, index))

    def pop():
        nonlocal anchors, hidden
        tag, index = stack[-1]
        if index >= 0:
            flush()
            blocks.pop()
        elif index == UNCLOSED:
            loose.pop()
        stack.pop()
        places[tag].pop()
        anchors -= tag == "a"
        hidden -= tag in HIDDEN

    def cut_to(size):
        while len(stack) > size:
            pop()

    def last(names):
        return max((places[t][-1] for t in names if places.get(t)), default=-1)

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.match(page, at)
        begin, at = at, m.end()
        tag = m[2]
        if tag is None:
            token = m[0]
            if token[:2] in ("<!", "<?"):
                continue
            if stack and stack[-1][0] == "head" and token.strip():
                pop()
            if not hidden:
                told = entities.unescape(token)
                pieces.append(told)
                if anchors:
                    linked += len(told.split())
            continue
        tag = tag.lower()
        if m[1]:
            if places.get(tag):
                cut_to(places[tag][-1])
            elif tag not in INLINE:
                flush()
            continue
        if hidden:
            # The head ends where something starts that cannot stand in it, a hidden element without an end tag at the next block.
            cuts = ([places["head"][0]] if places.get("head") and tag not in HEAD else []) + ([loose[0]] if loose and tag in ENDS_HIDDEN else [])
            if cuts:
                cut_to(min(cuts))
        if tag in ENDS_P and places.get("p") and last(WALLS_OF_P) < places["p"][-1]:
            # A paragraph ends with whatever is open inside it, unless a container came between.
            cut_to(places["p"][-1])
        if tag in SIBLINGS:
            own, walls = SIBLINGS[tag]
            wall = last(walls)
            inside = [places[t][k] for t in own if places.get(t) and (k := bisect_right(places[t], wall)) < len(places[t])]
            if inside:
                cut_to(min(inside))
        if tag in ("br", "hr"):
            if tag == "hr":
                flush()
            else:
                pieces.append(" ")
            continue
        if tag in VOID:
            continue
        rest = m[3] or ""
        if rest.rstrip().endswith("/") and tag not in INLINE and tag not in ENDS_P:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}", re.I).search(page, at)
            hidden += 1
            if close or tag not in ("noscript", "template"):
                at = close.start() if close else end
                push(tag, -1)
            else:
                push(tag, UNCLOSED)
            continue
        if tag in HIDDEN:
            hidden += 1
            if tag not in closed:
                closed[tag] = closed_starts(page, tag)
            push(tag, -1 if begin in closed[tag] or tag == "head" else UNCLOSED)
        elif tag in INLINE:
            anchors += tag == "a"
            push(tag, -1)
        else:
            flush()
            given = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(rest)} if rest else {}
            label = int(given["data-y"]) if labelled and "data-y" in given else None
            cues = " ".join(v for k, v in given.items() if k != "data-y").lower()
            push(tag, node(False, "article header" if tag == "header" and places.get("article") else tag, cues, "", 0, label))
    while stack:
        pop()
    flush()
    return dom


@lru_cache(maxsize=20_000)
def _element_features(tag: str, attributes: str) -> tuple[int, ...]:
    cues = [i for i, p in enumerate(_CUE_PATTERNS) if p.search(attributes)] if attributes else []
    if tag == "article" and any(i for i in cues):
        tag = "other article"  # a comment, a teaser: what it is called counts, not that it is an article
    return (0, *([1 + _TAGS.index(tag)] if tag in _TAGS else []), *(1 + len(_TAGS) + i for i in cues))


def _text_features(text: str, linked: int) -> tuple[int, ...]:
    words = text.count(" ") + 1
    share = linked / words
    length = N_ELEMENT + 4 + bisect_right(LENGTHS, words)
    return (N_ELEMENT, N_ELEMENT + 1 + (share > 0.2) + (share > 0.8), length, *([N_ELEMENT + 5 + len(LENGTHS)] if text[-1] in SENTENCE_ENDS else []))


class Forest:
    """Nodes of several pages as arrays, by depth, so that messages of one depth pass at once."""

    def __init__(self, doms: list[Dom]):
        sizes = [len(d.parent) for d in doms]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        n = int(self.first[-1])
        self.parent = np.array([p + f if p >= 0 else -1 for d, f in zip(doms, self.first) for p in d.parent], np.int64)
        self.leaf = np.array([x for d in doms for x in d.leaf], bool)
        self.label = np.array([x for d in doms for x in d.label], np.int64)
        features = [_text_features(t, k) if leaf else _element_features(g, a)
                    for d in doms for leaf, g, a, t, k in zip(d.leaf, d.tag, d.attributes, d.text, d.linked)]
        self.owner = np.repeat(np.arange(n), [len(f) for f in features]) if n else np.zeros(0, np.int64)
        self.feature = np.array([x for f in features for x in f], np.int64)
        depth = np.zeros(n, np.int64)
        for i, p in enumerate(self.parent.tolist()):  # parents come first
            if p >= 0:
                depth[i] = depth[p] + 1
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max() + 1))) if n else []


@dataclass
class Model:
    """Log potentials: of features for each state, and of parent-child states for elements and for text blocks."""

    weights: np.ndarray   # features x states
    edges: np.ndarray     # (element, text) x parent state x child state


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def marginals(model: Model, forest: Forest):
    """State marginals of every node, and the expected parent-child states by kind of child: messages up, then down."""
    n = len(forest.parent)
    below = np.zeros((n, STATES))
    if n:
        below[:] = np.stack([np.bincount(forest.owner, w[forest.feature], minlength=n) for w in model.weights.T], 1)
    kind, up = forest.leaf.astype(np.int64), np.zeros((n, STATES))
    for level in reversed(forest.levels[1:]):
        up[level] = _logsumexp(model.edges[kind[level]] + below[level][:, None], 2)
        np.add.at(below, forest.parent[level], up[level])
    belief = below.copy()
    expected = np.zeros_like(model.edges)
    for level in forest.levels[1:]:
        above = belief[forest.parent[level]] - up[level]
        joint = above[:, :, None] + model.edges[kind[level]]
        belief[level] = below[level] + _logsumexp(joint, 1)
        joint = joint + below[level][:, None]
        joint = np.exp(joint - joint.max((1, 2), keepdims=True))
        np.add.at(expected, kind[level], joint / joint.sum((1, 2), keepdims=True))
    p = np.exp(belief - belief.max(1, keepdims=True)) if n else belief
    return p / p.sum(1, keepdims=True) if n else p, expected


def train(doms: list[Dom], rounds: int = 400, rate: float = 0.1, penalty: float = 0.1) -> Model:
    """Maximum likelihood with a Gaussian prior, by Adam on exact marginals."""
    forest = Forest(doms)
    model = Model(np.zeros((N_ELEMENT + N_TEXT, STATES)), np.zeros((2, STATES, STATES)))
    y, has_parent = forest.label, forest.parent >= 0
    seen = np.zeros_like(model.edges)
    np.add.at(seen, (forest.leaf[has_parent].astype(int), y[forest.parent[has_parent]], y[has_parent]), 1)
    target = np.eye(STATES)[y]
    state = [np.zeros_like(model.weights), np.zeros_like(model.weights), np.zeros_like(seen), np.zeros_like(seen)]
    for step in range(1, rounds + 1):
        p, expected = marginals(model, forest)
        miss = (p - target)[forest.owner]
        gradients = (np.stack([np.bincount(forest.feature, miss[:, k], minlength=len(model.weights)) for k in range(STATES)], 1) + penalty * model.weights,
                     expected - seen + penalty * model.edges)
        for value, g, one, two in ((model.weights, gradients[0], state[0], state[1]), (model.edges, gradients[1], state[2], state[3])):
            one += 0.1 * (g - one)
            two += 0.01 * (g * g - two)
            value -= rate * (one / (1 - 0.9 ** step)) / (np.sqrt(two / (1 - 0.99 ** step)) + 1e-8)
    return model


#: Boxes of main text whose names tell what they hold; others are told by their text.
NAMED_WRAPS = ("div id=content", "div class=post-body", "div class='article-text'", "div id=main")


def labelled_pages(n: int = TRAINING_PAGES, seed: int = 21) -> list[str]:
    """Pages of varied layout; ``data-y`` has an element's state, which its descendants inherit."""
    rng = random.Random(seed)

    def words(low, high):
        text = " ".join("".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(low, high)))
        return text + (rng.choice(".!?") if rng.random() < (0.9 if low >= 10 else 0.3) else "")

    def paragraph(lengths=((1, 2), (3, 12), (10, 60), (30, 80))):
        return words(*rng.choice(lengths))

    def links(tag="li"):
        return "".join(f"<{tag}><a href='#'>{words(1, 3)}</a></{tag}>" for _ in range(rng.randint(2, 6)))

    def plain():
        return rng.choice("bcrxz") + rng.choice(["-", "", "_"]) + str(rng.randint(1, 99))

    def junk():
        kind = rng.choice(["nav", "header", "footer", "aside", "ad", "notice", "form", "talk", "reply", "share", "bare"])
        few = "".join(f"<p>{paragraph()}</p>" for _ in range(rng.randint(1, 3)))
        loose = rng.choice([paragraph(), few])
        if kind == "nav":
            return rng.choice([f"<nav data-y=2><ul>{links()}</ul></nav>", f"<div data-y=2 class='{rng.choice(['menu', 'main-nav', 'breadcrumbs', 'nav'])}'>{links('span')}</div>",
                               f"<ul data-y=2 class=menu>{links()}</ul>"])
        if kind == "header":
            return rng.choice([f"<header data-y=2><p>{paragraph()}</p></header>", f"<div data-y=2 id='{rng.choice(['header', 'masthead', 'top-bar'])}'><h1>{words(1, 4)}</h1>{loose}</div>",
                               f"<header data-y=2><h1>{words(1, 5)}</h1></header>"])
        if kind == "footer":
            return rng.choice([f"<footer data-y=2>{loose}</footer>", f"<div data-y=2 class='footer'>{loose}</div>"])
        if kind == "aside":
            return rng.choice([f"<aside data-y=2>{loose}</aside>", f"<div data-y=2 class='{rng.choice(['sidebar', 'widget', 'related', 'recommended'])}'><h3>{words(1, 3)}</h3>{loose}</div>"])
        if kind == "ad":
            return f"<{(box := rng.choice(['div', 'section', 'aside']))} data-y=2 class='{rng.choice(['ad', 'ads', 'advert', 'ad-box', 'sponsored', 'promo', 'top-ad'])}'>{loose}</{box}>"
        if kind == "notice":
            return f"<div data-y=2 {rng.choice(['class', 'id'])}='{rng.choice(['cookie', 'cookie-notice', 'consent', 'notice', 'alert', 'newsletter', 'popup'])}'>{loose}</div>"
        if kind == "form":
            return rng.choice([f"<form data-y=2><label>{words(1, 3)}</label><input type=text><p>{paragraph()}</p></form>",
                               f"<form data-y=2 class='{rng.choice(['search', 'login', ''])}'>{words(1, 4)}<button>{words(1, 1)}</button></form>"])
        if kind == "talk":
            tag = rng.choice(["section", "div", "ol"])
            inner = "".join(f"<{(box := rng.choice(['div', 'li', 'article']))} class='{rng.choice(['comment', 'reply', *([''] if box != 'article' else [])])}'><p>{paragraph()}</p></{box}>"
                            for _ in range(rng.randint(1, 4)))
            return f"<{tag} data-y=2 {rng.choice(['class', 'id'])}='{rng.choice(['comments', 'comment-list', 'discussion', 'responses reply', 'reactions'])}'><h3>{words(1, 3)}</h3>{inner}</{tag}>"
        if kind == "reply":
            return "".join(f"<article data-y=2 class='{rng.choice(['comment', 'reply', 'comment user', 'user-comment'])}'>{few}</article>" for _ in range(rng.randint(1, 3)))
        if kind == "bare":
            box = rng.choice(["div", f"div class={plain()}"])
            return rng.choice([f"<{box} data-y=2>{links('span')}</div>", f"<{box} data-y=2>{words(1, 3)}</div>", f"<{box} data-y=2><ul>{links()}</ul></div>"])
        return f"<div data-y=2 class='{rng.choice(['share', 'social', 'tags', 'follow-us'])}'>{links('span')}</div>"

    def content(lengths):
        kind = rng.random()
        if kind < 0.03:
            return f"<p><a href='#'>{paragraph(lengths)}</a></p>"
        if kind < 0.09:
            return rng.choice([paragraph(lengths), f"<div>{paragraph(lengths)}</div>", f"<div><div><p>{paragraph(lengths)}</p></div></div>"])
        if kind < 0.66:
            return f"<p>{'<b>' if rng.random() < 0.2 else ''}{paragraph(lengths)}{rng.choice(['', '', '<br>'])}{rng.choice(['</p>', '</p>', ''])}"
        if kind < 0.76:
            return f"<{(h := rng.choice(['h2', 'h3']))}>{words(1, 8)}</{h}>"
        if kind < 0.83:
            return f"<{(g := rng.choice(['ul', 'ol']))}>" + "".join(f"<li>{paragraph(lengths)}</li>" for _ in range(rng.randint(1, 4))) + f"</{g}>"
        if kind < 0.88:
            return f"<blockquote>{paragraph(lengths)}</blockquote>"
        if kind < 0.91:
            return f"<pre>{paragraph(lengths)}</pre>"
        if kind < 0.94:
            return "<table>" + "".join(f"<tr><td>{words(1, 3)}</td><td>{words(1, 9)}</td></tr>" for _ in range(2)) + "</table>"
        if kind < 0.97:
            return f"<figure><img src=x><figcaption>{paragraph(lengths)}</figcaption></figure>"
        return f"<{(d := rng.choice(['div', 'section']))}><p>{paragraph(lengths)}</p><p>{paragraph(lengths)}</p></{d}>"

    pages = []
    for _ in range(n):
        wrap = rng.choice(["article", "article", "main", "div id=content", "div class=post-body", "section class=entry", "div class='article-text'", "div id=main", "body", "body",
                           "div", "div", f"div class={plain()}", f"div class={plain()}"])
        bare = wrap.split()[0] == "div" and wrap not in NAMED_WRAPS
        lengths = rng.choice([((1, 2),), *[((1, 2), (3, 12), (10, 60), (30, 80))] * 3]) if not bare else ((3, 12), (10, 60), (30, 80))
        inner = [content(lengths) for _ in range(rng.randint(1, 3 if len(lengths) == 1 else 12))]
        if bare:
            inner.append(f"<p>{words(10, 60)}</p>")
        if rng.random() < 0.8:
            title = f"<h1>{words(2, 10)}</h1>"
            if wrap == "article" and rng.random() < 0.3:
                title = f"<header>{title}{rng.choice(['', f'<p>{paragraph(lengths)}</p>'])}</header>"
            inner.insert(0, title)
        for _ in range(rng.choice([0, 0, 1, 2])):
            inner.insert(rng.randint(0, len(inner)), junk())
        before, after = ("".join(junk() for _ in range(rng.randint(0, 3))) for _ in range(2))
        if wrap == "body":
            pages.append(f"<html data-y=0><head><title>{words(1, 5)}</title></head><body data-y=1>{before}{''.join(inner)}{after}</body></html>")
        else:
            name = wrap.split()[0]
            depth = rng.choice([1, 2, 4]) if rng.random() < 0.15 else 0
            inner = ["<div>" * depth, *inner, "</div>" * depth]
            body = f"<{wrap} data-y=1>{''.join(inner)}</{name}>"
            if bare and rng.random() < 0.5:
                body = f"<div data-y=1 class={plain()}>{body}</div>"
            body = f"{before}{body}{after}"
            if rng.random() < 0.3:
                body = f"<div data-y=0 class='{rng.choice(['wrapper', 'container', 'page', 'row'])}'>{body}</div>"
            if rng.random() < 0.25:
                # Fragments stand without a body.
                pages.append(body if rng.random() < 0.5 else f"<{wrap} data-y=1>{''.join(inner)}")
                continue
            pages.append(f"<!DOCTYPE html><html data-y=0><head><title>{words(1, 5)}</title><style>p{{}}</style></head><body data-y=0>{body}</body></html>")
    return pages


def extract(model: Model, pages: list[str]) -> list[str]:
    """Main text of every page: text blocks with a content marginal above one half, in page order."""
    doms = [parse(p) for p in pages]
    forest = Forest(doms)
    p, _ = marginals(model, forest)
    chosen = forest.leaf & (p[:, CONTENT] > 0.5) if len(p) else forest.leaf
    return ["\n".join(t for t, ok in zip(d.text, chosen[a:b]) if ok) for d, a, b in zip(doms, forest.first[:-1], forest.first[1:])]


def _extractor(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                pages, chars = [], 0
                while start + len(pages) < batch.num_rows and len(pages) < PAGES_AT_ONCE and chars < CHARS_AT_ONCE:
                    pages.append(batch.column(1)[start + len(pages)].as_py() or "")
                    chars += len(pages[-1])
                texts = extract(shared.value, pages)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(pages)), pa.array(texts, pa.string())], names=["row", "text"])
                start += len(pages)
    return run


def main_text(df: DataFrame, key: str = "page_id", html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` and ``text``: the main text of every page.

    Block elements and the runs of text between block boundaries are nodes of a tree. Node potentials weigh names, class and
    id cues, length and links; parent-child potentials tie a node to what it stands in. Messages pass up and down each page's
    tree (sum-product), and the text blocks with a content marginal above one half are the text: character references
    decoded, white space inside a block as one space, blocks joined by a newline. The potentials are fitted on
    ``TRAINING_PAGES`` labelled pages that ``labelled_pages`` writes.

    Null and empty pages, and pages without text, give an empty text; broken markup is repaired as it is met; null keys and
    repeated rows are extracted each; an empty table gives an empty result; other columns are ignored.
    """
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(train([parse(p, labelled=True) for p in labelled_pages()]))
    pages = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(html).cast("string").alias("html"))
    kind = StructType([pages.schema["row"], *StructType.fromDDL("text string")])
    return pages.mapInArrow(_extractor(shared), kind).select("row.*", "text")


@query("op7_main_text")
def op7_main_text(spark, folder):
    return main_text(read_table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))
