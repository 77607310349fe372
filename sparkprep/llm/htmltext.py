"""Main text of web pages by tag path ratios.

A page is read once into text blocks, each with the path of block tags from the root
(with the classes of the elements). Blocks with equal paths are one group: content
repeats a path (paragraph after paragraph) with long, punctuated text, while menus
repeat one with short text and none. For each path two ratios are taken, text length
per block and punctuation per block. Both are smoothed over neighbouring blocks in page
order, so that a heading gains from the paragraph after it; blocks of generic elements
(``div`` and the like), which may be anything, get nothing from their neighbours and weigh
less, and so do paths whose text is all links on a page without marks. A third ratio is
the share of the page's text in the path's containers: paths inside the deepest container
with most of the text (or in elements the page marks as article or main) weigh full,
others little. The three are fused by multiplication on a logarithmic scale, and a path is
content if its score reaches a share of the best.

Elements that by tag, role, class or id are menus, headers, footers, sidebars, notices,
adverts, forms or comments are suspects: their paths weigh little. A suspect that holds
three quarters of the marked text, or of all text without marks, is none: it wraps the page.
Scripts, styles, form fields and embedded objects are not read as text.

Text of one block is joined as it stands, white space as one space; blocks are joined
by one space. Every page is worked out alone from its whole source, in time linear in
its length, however deep or broken it is. A null or empty page has the empty text.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# One token: a comment or declaration, a tag with its attributes, or text.
_OTHER = r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)"
_TOKEN = re.compile(_OTHER + r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|([^<]+|<)", re.DOTALL)
# The same after a quote without an end: a tag ends at the next mark.
_TOKEN_PLAIN = re.compile(_OTHER + r"([^>]*)>|([^<]+|<)", re.DOTALL)
_TAG_LIKE = re.compile(r"</?[a-zA-Z]")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Fixed values of HTML: elements without an end, with raw text, and that are blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre "
    "search section summary table tbody td tfoot th thead title tr ul".split()
)
# A start tag of the first kind ends an open element of the second in the same container.
_ENDS_P = BLOCKS - {"html", "head", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt"}
_SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
_CONTAINERS = frozenset("ul ol dl table div section article main body aside nav header footer form".split())
# Elements whose text is not read.
UNREAD = RAW | frozenset("head button select option svg canvas object audio video".split())
# Elements that hold no main text unless they wrap it, by tag and by words in their class, id or role.
SUSPECT_TAGS = frozenset("nav header footer aside form menu dialog".split())
GENERIC = frozenset("div section center span table td details summary fieldset legend".split())
NAMES = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies disqus footer header legal menu modal nav navbar navigation "
    "newsletter notice notices notification paywall pagination popup promo promoted promotion related replies "
    "reply search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe toolbar "
    "warning widget widgets".split()
)
CONTENT = frozenset({"article", "main"})
_NAME = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，！？、]")
LAYOUT = frozenset("no with without has".split())  # "no-sidebar" is not a sidebar
OWN_HEADER = frozenset("article content entry post story title".split())
SMOOTHING = (1.0, 2.0, 1.0)
OUTSIDE = 0.01  # weight outside the container, and in a suspect
PLAIN = 0.25  # weight of a generic element
MAJORITY = 0.5
WRAPS = 0.75  # share of the text, or of the marked text, from which on a suspect wraps the page
LINKS = 0.9
SHARE = 0.05


@dataclass
class Node:
    """A block's text on one path."""

    path: int
    inside: bool  # in an element marked as the content
    suspect: int  # the nearest suspect around it, 0 if none
    parts: list[str] = field(default_factory=list)
    linked: int = 0  # characters in links

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


class Page:
    """Paths, suspects and text blocks of a page, in page order."""

    def __init__(self) -> None:
        self.tags, self.parents = [""], [0]  # of each path; path 0 is the root
        self.suspects = [0]  # for each suspect the one around it
        self.nodes: list[Node] = []
        self._numbers: dict[tuple[int, str], int] = {}

    def path(self, parent: int, tag: str, step: str) -> int:
        number = self._numbers.setdefault((parent, step), len(self.tags))
        if number == len(self.tags):
            self.tags.append(tag)
            self.parents.append(parent)
        return number

    def totals(self, own: dict[int, int], parents: list[int]) -> list[int]:
        """Sums over everything below each number; parents have smaller numbers."""
        sums = [own.get(i, 0) for i in range(len(parents))]
        for i in range(len(parents) - 1, 0, -1):
            sums[parents[i]] += sums[i]
        return sums


class _Open:
    """The open elements, with the places of each kind, so that no search walks them."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int, int, bool, bool, bool]] = []
        self.places: dict[str, list[int]] = {}

    def push(self, tag: str, *state) -> None:
        for kind in self._kinds(tag):
            self.places.setdefault(kind, []).append(len(self.stack))
        self.stack.append((tag, *state))

    def last(self, kind: str) -> int:
        places = self.places.get(kind)
        return places[-1] if places else -1

    def cut(self, place: int) -> None:
        while len(self.stack) > place:
            for kind in self._kinds(self.stack.pop()[0]):
                self.places[kind].pop()

    def close(self, tag: str) -> None:
        """Close the nearest open element of this name, and those inside it."""
        at = self.last(tag)
        # An end tag inside a block does not reach beyond it, unless it is a block's own.
        if at >= 0 and (tag in BLOCKS or at > self.last("#block")):
            self.cut(at)

    def end_implied(self, tag: str) -> None:
        """Close elements that a start tag ends without an end tag."""
        ends = {"p"} if tag in _ENDS_P else _SIBLINGS.get(tag)
        at = max((self.last(e) for e in ends), default=-1) if ends else -1
        if at > self.last("#container"):
            self.cut(at)

    @staticmethod
    def _kinds(tag: str):
        yield tag
        if tag in BLOCKS:
            yield "#block"
        if tag in _CONTAINERS:
            yield "#container"


def read(source: str) -> Page:
    """Paths and text blocks of a page."""
    page, opened = Page(), _Open()
    current: Node | None = None
    raw_until = ""
    last_mark = source.rfind(">")
    token, at = _TOKEN, 0
    while at < len(source):
        if raw_until:
            end = re.compile(rf"</{re.escape(raw_until)}[\s/>]|\Z", re.IGNORECASE).search(source, at)
            at, raw_until = end.start(), ""
            if at >= len(source):
                break
        if at > last_mark and not source.startswith("<!--", at):
            closing = tag = attributes = None  # no tag can follow
            text, at = source[at:], len(source)
            text = text.partition("<!--")[0]
        else:
            m = token.match(source, at)
            if m[4] == "<" and token is _TOKEN and _TAG_LIKE.match(source, at):
                token = _TOKEN_PLAIN  # a quote has no end; looked for once only
                m = token.match(source, at)
            at = m.end()
            closing, tag, attributes, text = m.groups()
        _, path, suspect, unread, inside, link = opened.stack[-1] if opened.stack else ("", 0, 0, False, False, False)
        if text is not None:
            if unread:
                continue
            if current is None:
                current = Node(path, inside, suspect)
                page.nodes.append(current)
            text = html.unescape(text) if "&" in text else text
            current.parts.append(text)
            current.linked += len(text) if link else 0
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            current = None
        elif tag == "br" and current is not None:
            current.parts.append(" ")
        if closing:
            opened.close(tag)
            continue
        if tag in VOID:
            continue
        opened.end_implied(tag)
        _, path, suspect, unread, inside, link = opened.stack[-1] if opened.stack else ("", 0, 0, False, False, False)
        names = _names(attributes)
        if tag in BLOCKS:
            path = page.path(path, tag, ".".join([tag, *sorted(names)]))
        if tag in CONTENT and not unread:
            inside = True
        elif _is_suspect(tag, names, inside):
            page.suspects.append(suspect)
            suspect = len(page.suspects) - 1
        opened.push(tag, path, suspect, unread or tag in UNREAD, inside, link or tag == "a")
        if tag in RAW:
            raw_until = tag
    return page


def _names(attributes: str) -> set[str]:
    """Words in the class, id and role of a tag."""
    if not attributes or "=" not in attributes:
        return set()
    found: set[str] = set()
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            found.update(_NAME.findall((a or b or c).lower()))
    return found


def _is_suspect(tag: str, names: set[str], inside: bool) -> bool:
    """Whether an element looks like no content. An article's own header holds its title."""
    if tag == "header":
        return not inside
    if tag in SUSPECT_TAGS:
        return True
    if tag in ("html", "body") or not names.isdisjoint(LAYOUT):
        return False
    found = names & NAMES
    if found == {"header"} and (inside or not names.isdisjoint(OWN_HEADER)):
        return False
    return bool(found)


def _suspected(page: Page, nodes: list[Node], texts: list[str]) -> list[bool]:
    """For each suspect whether it or one around it is one, and does not wrap the content."""
    any_marked = any(node.inside for node in nodes)
    own: dict[int, int] = {}
    for node, text in zip(nodes, texts):
        if node.inside or not any_marked:
            own[node.suspect] = own.get(node.suspect, 0) + len(text)
    held = page.totals(own, page.suspects)
    out = [False]
    for i in range(1, len(page.suspects)):
        out.append(held[i] < WRAPS * held[0] or not held[0] or out[page.suspects[i]])
    return out


def path_scores(
    page: Page, nodes: list[Node], texts: list[str], suspected: list[bool]
) -> dict[tuple[int, bool], float]:
    """The fused score of each path, apart for its blocks in suspects; nodes with their texts in page order."""
    length: dict[int, int] = {}
    linked: dict[int, int] = {}
    marks: dict[int, int] = {}
    count: dict[int, int] = {}
    for node, text in zip(nodes, texts):
        length[node.path] = length.get(node.path, 0) + len(text)
        linked[node.path] = linked.get(node.path, 0) + min(len(text), node.linked)
        marks[node.path] = marks.get(node.path, 0) + len(_PUNCTUATION.findall(text))
        count[node.path] = count.get(node.path, 0) + 1
    marked_paths = any(node.inside for node in nodes)
    held = container(page, length)
    below = [False] * len(page.tags)
    for path in range(len(page.tags)):
        parent = page.parents[path]
        below[path] = path == held or (path > 0 and below[parent])
    kinds = [(node.path, suspected[node.suspect]) for node in nodes]
    within = [(n.inside if marked_paths else below[n.path]) and not s for n, (_, s) in zip(nodes, kinds)]
    plain = {
        p: page.tags[p] in GENERIC or (not marked_paths and linked[p] >= LINKS * length[p]) for p in length
    }
    means = [length[n.path] / count[n.path] for n in nodes], [marks[n.path] / count[n.path] for n in nodes]
    smooth = [_smooth(m, within) for m in means]
    fused: dict[tuple[int, bool], list[float]] = {}
    for i, (kind, inner) in enumerate(zip(kinds, within)):
        low = plain[kind[0]]
        a, b = (m[i] for m in (means if low else smooth))
        weight = (1.0 if inner else OUTSIDE) * (PLAIN if low else 1.0)
        fused.setdefault(kind, []).append(math.log1p(a) * (1.0 + math.log1p(b)) * weight)
    return {k: sum(v) / len(v) for k, v in fused.items()}


def container(page: Page, length: dict[int, int]) -> int:
    """The deepest path that holds most of the text in itself and the paths below it, blocks apart.

    A path whose own blocks are most of the text is content itself: its parent is the container.
    """
    held = page.totals(length, page.parents)
    best = 0  # paths with most of the text lie on one line from the root
    for path in range(1, len(held)):
        if held[path] - length.get(path, 0) > MAJORITY * held[0] and page.parents[path] == best:
            best = path
    return best


def _smooth(values: list[float], side: list[bool]) -> list[float]:
    """A weighted mean with both neighbours, as far as they are on the same side."""
    before, own, after = SMOOTHING
    last = len(values) - 1
    out = []
    for i, v in enumerate(values):
        a = values[i - 1] if i and side[i - 1] == side[i] else v
        b = values[i + 1] if i < last and side[i + 1] == side[i] else v
        out.append((before * a + own * v + after * b) / sum(SMOOTHING))
    return out


def extract(source: str | None) -> str:
    """The main text of a page."""
    page = read(source or "")
    found = [(n, t) for n in page.nodes if (t := n.text())]
    nodes, texts = [n for n, _ in found], [t for _, t in found]
    suspected = _suspected(page, nodes, texts)
    scores = path_scores(page, nodes, texts, suspected)
    level = SHARE * max(scores.values(), default=0.0)
    return " ".join(t for n, t in found if scores[n.path, suspected[n.suspect]] >= level)


def _extract(batches):
    for batch in batches:
        texts = [extract(s) for s in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], "text"]
        )


def extract_text(df: DataFrame, source: str = "html") -> DataFrame:
    """``df`` without the page source and with ``text``, never null."""
    rows = df.select(*[c for c in df.columns if c not in (source, "text")], F.col(source))
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(_extract, ", ".join([*names, "text string"]))
