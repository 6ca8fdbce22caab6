"""Operator 4: main text of web pages by a tree-structured graphical model.

A page's elements make a tree. Every element is content or not. Unary
potentials say how likely its features are for either, pairwise potentials how
likely a child of its kind is content below a parent that is or isn't. Sum-product
messages go from the leaves to the root and back, which gives the exact
probability of content for each element from the whole page. Potentials are
learned by counting on labelled pages (``labelled_pages``), with a count of
``SMOOTH`` added to each case.

A block is the text between the borders of block-level elements; it is kept if
the element that holds it is more likely content than not.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirwatch.llm import stages
from weirwatch.llm.words import blocks

SMOOTH = 0.5
UNARY_WEIGHT = 0.25

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body caption dd dt head html legend li option select summary tbody td tfoot th thead tr".split())
#: What an opening element closes first, and where the search for it ends.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "body": ({"head"}, set()),
}
KIND = {t: k for k, names in {
    "main": "article main", "nav": "nav menu", "header": "header", "footer": "footer", "aside": "aside dialog", "form": "form fieldset input button select option textarea label legend",
    "unseen": "script style noscript template head title meta link iframe", "heading": "h1 h2 h3 h4 h5 h6", "text": "p blockquote pre dd dt figcaption",
    "list": "ul ol dl", "item": "li", "box": "div section center td th tr table tbody figure details html body", "link": "a",
}.items() for t in names.split()}
BAD_HINT = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|banner|breadcrumbs?|byline-share|comments?|commentlist|cookies?|consent|copyright|disqus|footer|foot|gdpr|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|"
    r"notice|pager|pagination|popup|promo\w*|recommend\w*|related|replies|respond|search|share|sharing|sidebar|side|signup|skip|social|sponsor\w*|subscribe|tags?|toolbar|topbar|trending|widget\w*)(?:[^a-z]|$)"
)
GOOD_HINT = re.compile(r"(?:^|[^a-z])(?:article|articlebody|body-text|content|entry|main|maincontent|page-content|post|post-body|prose|story|text)(?:[^a-z]|$)")
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SENTENCE = re.compile(r"""[.!?…。]["'”’)\]]*\s*$""")


class Tree:
    """Elements of a page in order of their start: parent, tag, hint text; and the text pieces with the element of each."""

    def __init__(self, page: str):
        self.parent, self.tag, self.hint, self.label = [-1], ["html"], [""], [None]
        #: (block-level element, piece); None as piece is a border between blocks.
        self.pieces: list[tuple[int, str | None]] = []
        self.inside: list[int] = []
        self._read(page)

    def _read(self, page: str) -> None:
        stack, block = [0], [0]  # open elements, and the nearest block-level element of each
        at, end = 0, len(page)
        while at < end:
            found = _TOKEN.search(page, at)
            if found is None:
                self._text(stack, block, page[at:])
                return
            if found.start() > at:
                self._text(stack, block, page[at : found.start()])
            at = found.end()
            closing, name, rest = found.groups()
            if name is None:
                continue
            name = name.lower()
            if closing:
                self._close(stack, block, name)
                continue
            self._open(stack, block, name, rest)
            if name in RAW and not rest.endswith("/"):
                stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = stop.end() if stop else end
                self._pop(stack, block, len(stack) - 1)

    def _text(self, stack: list[int], block: list[int], text: str) -> None:
        self.pieces.append((block[-1], text))
        self.inside.append(stack[-1])

    def _pop(self, stack: list[int], block: list[int], to: int) -> None:
        while len(stack) > max(to, 1):
            if self.tag[stack[-1]] in BLOCK:
                self._border(block[-1])
            stack.pop()
            block.pop()

    def _border(self, element: int) -> None:
        self.pieces.append((element, None))
        self.inside.append(element)

    def _close(self, stack: list[int], block: list[int], name: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[i]]
            if tag == name:
                self._pop(stack, block, i)
                return
            if name not in BLOCK and tag in BLOCK:
                return  # an inline end doesn't end blocks

    def _open(self, stack: list[int], block: list[int], name: str, rest: str) -> None:
        if name in ("html", "body") and len(stack) == 1 and name == "html":
            return
        what, until = CLOSES.get(name, (set(), set()))
        if name in CLOSES_P:
            what, until = what | {"p"}, until | {"td", "th", "button", "table"}
        if what:
            cut = None
            for i in range(len(stack) - 1, 0, -1):
                tag = self.tag[stack[i]]
                if tag in what:
                    cut = i
                elif tag in until or (tag in BLOCK and cut is None and "p" in what and tag not in what):
                    break
            if cut is not None:
                self._pop(stack, block, cut)
        element = len(self.tag)
        hints, label = [], None
        if "=" in rest:
            for key, a, b, c in _ATTRIBUTE.findall(rest):
                if key.lower() == "data-main":
                    label = (a or b or c) == "1"
                else:
                    hints.append(a or b or c)
        self.parent.append(stack[-1])
        self.tag.append(name)
        self.hint.append(" ".join(hints).lower())
        self.label.append(label)
        if name in BLOCK:
            self._border(element)
        if name == "br":
            self.pieces.append((block[-1], " "))
            self.inside.append(stack[-1])
        if name not in VOID and not rest.endswith("/"):
            stack.append(element)
            block.append(element if name in BLOCK else block[-1])

    def blocks(self) -> Iterator[tuple[int, str]]:
        """(block-level element, text) in page order; character references are read, white space is one space."""
        parts: list[str] = []
        last = 0
        for element, piece in [*self.pieces, (0, None)]:
            if piece is None or element != last:
                if parts and (text := " ".join(html.unescape("".join(parts)).split())):
                    yield last, text
                parts = []
            last = element
            if piece is not None:
                parts.append(piece)

    def features(self) -> list[tuple]:
        """For each element: kind, hint, words in it, share of them in links, whether its text ends as a sentence."""
        n = len(self.tag)
        words, linked, ends = [0] * n, [0] * n, [0] * n
        in_link = [False] * n
        for i in range(n):
            in_link[i] = self.tag[i] == "a" or (i > 0 and in_link[self.parent[i]])
        for (_, piece), element in zip(self.pieces, self.inside):
            if piece:
                count = len(piece.split())
                words[element] += count
                linked[element] += count * in_link[element]
                if count:
                    ends[element] = 2 if _SENTENCE.search(piece) else 1
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            words[p] += words[i]
            linked[p] += linked[i]
            ends[p] = max(ends[p], ends[i])
        out = []
        for i in range(n):
            w = words[i]
            share = linked[i] / w if w else 0.0
            hint = self.hint[i]
            kind = KIND.get(self.tag[i], "inline")
            mark = "bad" if hint and BAD_HINT.search(hint) else "good" if hint and GOOD_HINT.search(hint) else "none"
            size = 0 if w == 0 else 1 if w <= 5 else 2 if w <= 20 else 3 if w <= 80 else 4
            link = 0 if share == 0 else 1 if share <= 0.3 else 2 if share <= 0.7 else 3
            out.append((kind, mark, size, link, ends[i]))
        return out


@dataclass(frozen=True)
class Potentials:
    """Logarithms. ``unary`` of (feature, value) and ``pairs`` of (child kind, child hint, whether the parent's hint is bad), by both labels."""

    unary: dict[tuple[int, object], tuple[float, float]]
    pairs: dict[tuple[str, str, bool], tuple[tuple[float, float], tuple[float, float]]]
    default: tuple[tuple[float, float], tuple[float, float]]


def content_marginals(tree: Tree, potentials: Potentials) -> list[float]:
    """The probability of content for every element, by messages up and down the tree."""
    features, parent, n = tree.features(), tree.parent, len(tree.tag)
    own = []
    for f in features:
        no = yes = 0.0
        for i in range(2, 5):
            a, b = potentials.unary.get((i, (f[0] in ("main", "box"), f[i])), (0.0, 0.0))
            no, yes = no + a, yes + b
        own.append([no, yes])
    own[0][1] -= 20.0  # the root is no content
    edge = [potentials.pairs.get(_pair(features, parent, i), potentials.default) for i in range(n)]
    up = [(0.0, 0.0)] * n
    for i in range(n - 1, 0, -1):
        (nn, ny), (yn, yy) = edge[i]
        no, yes = own[i]
        up[i] = _log_add(nn + no, ny + yes), _log_add(yn + no, yy + yes)
        mine = own[parent[i]]
        mine[0] += up[i][0]
        mine[1] += up[i][1]
    out = [0.0] * n
    belief = [own[0]] + [None] * (n - 1)
    for i in range(1, n):
        # What the parent believes without this child's message.
        no, yes = belief[parent[i]][0] - up[i][0], belief[parent[i]][1] - up[i][1]
        (nn, ny), (yn, yy) = edge[i]
        belief[i] = [own[i][0] + _log_add(no + nn, yes + yn), own[i][1] + _log_add(no + ny, yes + yy)]
        out[i] = 1 / (1 + math.exp(min(700.0, belief[i][0] - belief[i][1])))
    return out


def _pair(features: list[tuple], parent: list[int], i: int) -> tuple[str, str, bool]:
    return features[i][0], features[i][1], i > 0 and features[parent[i]][1] == "bad"


def _log_add(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def main_text(page: str, potentials: Potentials) -> str:
    """The content blocks of a page, joined by two line ends."""
    tree = Tree(page)
    marginals = content_marginals(tree, potentials)
    return "\n\n".join(text for element, text in tree.blocks() if marginals[element] >= 0.5)


def learn(pages: list[str]) -> Potentials:
    """Count on labelled pages: an element says ``data-main="1"`` or ``"0"`` for itself and what is in it; the page is no content."""
    unary: Counter = Counter()
    pairs: Counter = Counter()
    total: Counter = Counter()
    for page in pages:
        tree = Tree(page)
        features = tree.features()
        label = [False] * len(tree.tag)
        for i in range(1, len(label)):
            label[i] = tree.label[i] if tree.label[i] is not None else label[tree.parent[i]]
            f, y = features[i], int(label[i])
            holder = f[0] in ("main", "box")
            total[holder, y] += 1
            for k in range(2, 5):
                unary[k, (holder, f[k]), y] += 1
            pairs[*_pair(features, tree.parent, i), int(label[tree.parent[i]]), y] += 1
    levels = {2: 5, 3: 4, 4: 3}
    # Features of one element, and of its neighbours, say much the same.
    one = {(k, (h, v)): tuple(UNARY_WEIGHT * math.log((unary[k, (h, v), y] + SMOOTH) / (total[h, y] + SMOOTH * levels[k])) for y in (0, 1)) for k in levels for h in (False, True) for v in range(levels[k])}

    def two(cases: Counter, key: tuple) -> tuple:
        rows = []
        for p in (0, 1):
            # Without evidence a child is what its parent is.
            a, b = cases[(*key, p, 0)] + SMOOTH * (2 if p == 0 else 0.1), cases[(*key, p, 1)] + SMOOTH * (2 if p else 0.1)
            rows.append((math.log(a / (a + b)), math.log(b / (a + b))))
        return tuple(rows)

    keys = {k[:3] for k in pairs}
    any_: Counter = Counter()
    for (_, mark, _, p, y), n in pairs.items():
        if mark == "none":
            any_[p, y] += n
    return Potentials(one, {k: two(pairs, k) for k in keys}, two(any_, ()))


def labelled_pages(n: int = 600, seed: int = 4) -> list[str]:
    """Pages of common layouts with known content, drawn by a seeded generator."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("aeiourstnlmd") for _ in range(draw.randint(2, 9)))
    words = lambda a, b: " ".join(word() for _ in range(draw.randint(a, b)))
    sentence = lambda: words(1, 16).capitalize() + draw.choice(["", ",", "."]) + "."
    paragraph = lambda: "<p>" + " ".join(sentence() for _ in range(draw.choice([1, 1, 2, 4, 8]))) + draw.choice(["</p>", "</p>", ""])
    links = lambda a, b: "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(draw.randint(a, b)))
    some = lambda p, make: make() if draw.random() < p else ""
    hint = lambda names: draw.choice([f'class="{draw.choice(names)}"', f'id="{draw.choice(names)}"'])

    def article() -> str:
        parts = [f"<h1>{words(2, 9)}</h1>", some(0.2, lambda: f'<p class="lead">{sentence()}</p>')]
        for _ in range(draw.randint(1, 14)):
            parts.append(draw.choice([paragraph] * 12 + [
                lambda: f"<h2>{words(1, 6)}</h2>", lambda: f"<p><b>{sentence()}<br>", lambda: f"<blockquote>{paragraph()}</blockquote>", lambda: f"<p>{words(3, 20)} <a href='/x'>{words(1, 3)}</a> {sentence()}</p>",
                lambda: "<ul>" + "".join(f"<li>{sentence()}</li>" for _ in range(draw.randint(2, 6))) + "</ul>", lambda: f"<pre>{words(4, 30)}</pre>", lambda: f"<div>{sentence()}</div>",
                lambda: f"<figure><img src='x'><figcaption>{words(3, 9)}</figcaption></figure>", lambda: f"<table><tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr></table>",
            ])())
            parts.append(some(0.06, lambda: f'<div {hint(["ad", "advert", "sponsor", "promo"])} data-main="0">{sentence()}</div>'))
        parts.append(some(0.15, lambda: f'<aside data-main="0"><p>{sentence()}</p></aside>'))
        parts.append(some(0.15, lambda: f'<form data-main="0"><label>{words(1, 3)}</label><input><button>{word()}</button></form>'))
        parts.append(some(0.15, lambda: f'<footer data-main="0"><p>{words(2, 8)}</p><a href="/t">{word()}</a></footer>'))
        parts.append(some(0.25, comments))
        return "".join(parts)

    def comments() -> str:
        body = "".join(f"<{t}><p>{sentence()}</p></{t}>" for t in draw.choices(["div", "li", "article"], k=draw.randint(1, 6)))
        return f'<section {hint(["comments", "comment-list", "disqus", "replies"])} data-main="0"><h3>{words(1, 2)}</h3>{body}</section>'

    def page() -> str:
        around = lambda t, names, body: draw.choice([f"<{t}>{body}</{t}>", f"<div {hint(names)}>{body}</div>"])
        top = around("header", ["header", "masthead", "topbar"], f"<div>{words(1, 4)}</div><p>{words(2, 8)}</p>") if draw.random() < 0.5 else ""
        menu = around("nav", ["nav", "menu", "navigation"], f"<ul>{links(3, 9)}</ul>") if draw.random() < 0.9 else f"<ul>{links(4, 9)}</ul>"
        side = some(0.5, lambda: around("aside", ["sidebar", "widget", "related"], f"<h4>{words(1, 3)}</h4><ul>{links(2, 6)}</ul><p>{sentence()}</p>"))
        note = some(0.4, lambda: f'<div {hint(["cookie-notice", "cookies", "consent", "popup", "notice", "newsletter"])}><p>{sentence()}</p><button>{word()}</button></div>')
        ad = some(0.6, lambda: f'<div {hint(["ad", "ads", "advert", "banner", "sponsor"])}>{draw.choice([sentence(), f"<p>{sentence()}</p>"])}</div>')
        search = some(0.3, lambda: f"<form><label>{words(1, 2)}</label><input><select><option>{word()}</option></select><button>{word()}</button></form>")
        body = article()
        main = draw.choice([
            f'<article data-main="1">{body}</article>', f'<article data-main="1">{body}</article>', f'<main data-main="1">{body}</main>', f'<main data-main="1"><article>{body}</article></main>',
            f'<div {hint(["content", "post", "entry-content", "main", "story"])} data-main="1">{body}</div>', f'<div {hint(["content", "main"])} data-main="1"><article>{body}</article></div>',
            f'<section data-main="1">{body}</section>', f'<div data-main="1">{body}</div>',
        ])
        rest = [main, side]
        draw.shuffle(rest)
        foot = around("footer", ["footer", "copyright"], f"&copy; {words(2, 9)} <a href='/i'>{word()}</a>{some(0.4, lambda: f'<p>{sentence()}</p>')}")
        after = some(0.25, comments)
        wrapped = top + menu + ad + search + "".join(rest) + after + note + foot
        if draw.random() < 0.4:
            wrapped = f'<div class="{draw.choice(["wrapper", "container", "page"])}">{wrapped}</div>'
        return f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{wrapped}</body></html>"

    return [page() for _ in range(n)]


def extract(pages: DataFrame, potentials: Potentials | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``.

    Null or empty html has the empty text; so has a page without content.
    Broken markup is read as far as it goes. Repeated rows are read each. Other
    columns are left out.
    """
    model = potentials or learn(labelled_pages())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in blocks(batch.column("html"), 4 << 20):
                part = batch.slice(a, b - a)
                texts = [main_text(x, model) if x else "" for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
                )

    stages.small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
