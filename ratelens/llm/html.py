"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut at block tags. A block has its words and link density and those of its neighbours, and what
kind of container it stands in. A small decision tree, grown from the labelled table below, says which
blocks are main text.
"""

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ratelens.llm.common import with_ids_as_text

# What HTML says of its elements, and names that sites give to what is not the article.
DROPPED = re.compile(r"<!--(?:-?>)?|<(script|style|noscript|template|svg|iframe|object|select|textarea|button|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>", re.I)
ENDS = {n: re.compile(rf"<(/?){n}\b[^>]*>", re.I) for n in "script style noscript template svg iframe object select textarea button title".split()}
COMMENT_END = re.compile("--!?>")
RAW = set("script style textarea iframe".split())  # the first closing tag ends them, whatever stands before it
NESTED = set("noscript template svg object".split())
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/]?[a-zA-Z][^<>]*>|<[!?][^<>]*>")
INLINE = set("a abbr b bdi bdo cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
CONTAINERS = set("article main section div nav header footer aside form ul ol dl table body figure fieldset dialog menu".split())
LEAVES = set("p li td th tr dt dd h1 h2 h3 h4 h5 h6 blockquote pre address center details summary figcaption caption hgroup thead tbody tfoot".split())
#: What an opening tag ends, up to the next list or table: elements whose closing tags may be left out.
ENDED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}} | {n: {"thead", "tbody", "tfoot", "tr", "td", "th"} for n in ("thead", "tbody", "tfoot")}
BOUNDS = set("ul ol dl table".split())
BLOCK = re.compile(r"</?(?:" + "|".join(sorted(CONTAINERS | LEAVES | {"html", "head"})) + r")\b", re.I)
CHROME = set("nav header footer aside form fieldset dialog menu".split())
CHROME_NAMES = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side|menu|nav\w*|breadcrumbs?|footer|header|masthead|comments?|respond|reply|cookies?|consent|notices?|alert|popup|modal|newsletter|subscribe|signup|login|share|social|related|recommended|widget|toolbar|copyright|disqus)(?:$|[\s_-])", re.I)
SAID_OF_PAGE = re.compile(r"(?<!\S)(?:has|have|with|without|no|hide|show)[_-]\S*", re.I)  # what a page has, not what the element is
HOLDS_MAIN = re.compile(r"<main\b", re.I)
MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|story|entry|body|text)(?:$|[\s_-])", re.I)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

FEATURES = ("words", "links", "before", "before_links", "after", "after_links", "chrome", "main", "heading")
# Labelled blocks (FEATURES, then 1 for main text): link densities are parts of 1.
LABELLED = (
    (120, 0.0, 9, 0.0, 80, 0.0, 0, 1, 0, 1), (80, 0.02, 120, 0.0, 60, 0.0, 0, 1, 0, 1), (45, 0.1, 80, 0.0, 30, 0.1, 0, 1, 0, 1),
    (30, 0.0, 45, 0.1, 2, 0.0, 0, 1, 0, 1), (2, 0.0, 30, 0.0, 55, 0.0, 0, 1, 0, 1), (1, 0.0, 2, 0.0, 1, 0.0, 0, 1, 0, 1),
    (9, 0.0, 14, 0.0, 120, 0.0, 0, 1, 1, 1), (4, 0.0, 40, 0.0, 70, 0.0, 0, 1, 1, 1), (12, 0.4, 60, 0.0, 50, 0.0, 0, 1, 0, 1),
    (6, 1.0, 25, 0.0, 35, 0.0, 0, 1, 0, 1), (3, 0.0, 1, 1.0, 1, 0.0, 0, 1, 0, 1), (1, 0.0, 12, 0.0, 7, 0.0, 0, 1, 1, 1),
    (200, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (70, 0.0, 5, 0.0, 60, 0.05, 0, 0, 0, 1), (40, 0.1, 70, 0.0, 25, 0.0, 0, 0, 0, 1),
    (18, 0.0, 40, 0.1, 45, 0.0, 0, 0, 0, 1), (5, 0.0, 45, 0.0, 60, 0.0, 0, 0, 0, 1), (7, 0.0, 1, 1.0, 90, 0.0, 0, 0, 1, 1),
    (25, 0.2, 30, 0.0, 20, 0.0, 0, 0, 0, 1), (12, 0.0, 30, 0.1, 1, 1.0, 0, 0, 0, 1),
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0), (2, 1.0, 1, 1.0, 14, 0.0, 1, 0, 0, 0),
    (14, 0.0, 1, 1.0, 9, 0.0, 1, 0, 0, 0), (60, 0.0, 9, 0.0, 40, 0.0, 1, 0, 0, 0), (9, 0.1, 80, 0.0, 0, 0.0, 1, 0, 0, 0),
    (35, 0.0, 50, 0.0, 20, 0.3, 1, 1, 0, 0), (15, 0.0, 35, 0.0, 0, 0.0, 1, 1, 1, 0), (4, 0.0, 100, 0.0, 6, 0.0, 1, 1, 0, 0),
    (6, 0.0, 3, 0.0, 12, 0.0, 1, 0, 1, 0), (150, 0.0, 10, 0.0, 90, 0.0, 1, 0, 0, 0), (20, 0.6, 4, 1.0, 2, 1.0, 1, 0, 0, 0),
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0), (2, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0), (3, 1.0, 2, 1.0, 50, 0.0, 0, 0, 0, 0),
    (8, 0.9, 3, 1.0, 5, 1.0, 0, 0, 0, 0), (15, 0.8, 6, 0.9, 9, 0.9, 0, 0, 0, 0), (3, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0),
    (4, 0.0, 0, 0.0, 3, 1.0, 0, 0, 0, 0), (5, 0.4, 4, 0.9, 0, 0.0, 0, 0, 0, 0), (6, 0.0, 3, 0.7, 0, 0.0, 0, 0, 0, 0),
    (10, 0.0, 2, 1.0, 80, 0.0, 0, 1, 1, 1), (60, 0.0, 3, 1.0, 40, 0.0, 0, 1, 0, 1), (50, 0.0, 40, 0.0, 2, 1.0, 0, 1, 0, 1),
    (3, 0.0, 20, 0.9, 5, 1.0, 0, 1, 0, 1), (2, 1.0, 3, 1.0, 2, 1.0, 0, 1, 0, 1), (4, 0.8, 6, 1.0, 9, 0.7, 0, 1, 0, 1),
    (70, 0.0, 2, 1.0, 60, 0.0, 0, 0, 0, 1), (60, 0.0, 30, 0.0, 2, 1.0, 0, 0, 0, 1), (45, 0.1, 3, 1.0, 2, 1.0, 0, 0, 0, 1),
    (22, 0.95, 10, 0.9, 12, 1.0, 0, 0, 0, 0), (2, 0.0, 2, 0.0, 1, 1.0, 0, 0, 0, 0),
)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 6):
    """A tree by Gini impurity: (feature, cut, below, above), or the label of a leaf."""
    if depth == 0 or len(set(labels)) == 1:
        return int(2 * labels.sum() > len(labels))
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = rows[:, f] < cut
            score = sum(len(s) * (p := s.mean()) * (1 - p) for s in (labels[low], labels[~low]))
            if best is None or score < best[0] - 1e-12:
                best = (score, f, float(cut), low)
    if best is None:
        return int(2 * labels.sum() > len(labels))
    _, f, cut, low = best
    return f, cut, grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1)


def tree():
    table = np.array(LABELLED, float)
    return grow(table[:, :-1], table[:, -1])


def decide(node, row: tuple) -> int:
    while not isinstance(node, int):
        node = node[2] if row[node[0]] < node[1] else node[3]
    return node


def paired(page: str, name: str) -> dict[int, int]:
    """Where each closed element of ``name`` starts, and where it ends; a closing tag is that of the last one open."""
    out, opened = {}, []
    for tag in ENDS[name].finditer(page):
        if tag[1]:
            if opened:
                out[opened.pop()] = tag.end()
        elif name == "svg" and tag[0].endswith("/>"):
            out[tag.start()] = tag.end()
        else:
            opened.append(tag.start())
    return out


def visible(page: str) -> str:
    """``page`` with comments and elements that show no text as spaces; an unclosed one ends at the next block tag."""
    out, at, unclosed, pairs = [], 0, set(), {}
    while found := DROPPED.search(page, at):
        out.append(page[at : found.start()])
        name, at, end = (found[1] or "").lower(), found.end(), None
        if not name and found[0] != "<!--":
            end = at  # an empty comment
        elif name in NESTED:
            if name not in pairs:
                pairs[name] = paired(page, name)
            end = pairs[name].get(found.start())
        elif name not in unclosed:
            tags = (ENDS[name] if name else COMMENT_END).finditer(page, at)
            tag = next((t for t in tags if not name or t[1] or name not in RAW), None)
            if tag is None:
                unclosed.add(name)
            elif not name or tag[1]:
                end = tag.end()  # else the next one begins first: this one was not closed
        if end is None:
            block = BLOCK.search(page, at)
            end = block.start() if block else len(page)
        out.append(" ")
        at = end
    out.append(page[at:])
    return "".join(out)


class Open:
    """The stack of open elements, with where each name stands in it, so that no tag looks through all of it."""

    def __init__(self, root: "Element"):
        self.stack, self.places = [root], {}

    def push(self, element: "Element") -> None:
        self.places.setdefault(element.name, []).append(len(self.stack))
        self.stack.append(element)

    def cut(self, at: int) -> None:
        """Close everything from the place ``at`` upward."""
        while len(self.stack) > at:
            self.places[self.stack.pop().name].pop()

    def last(self, name: str) -> int:
        places = self.places.get(name)
        return places[-1] if places else 0

    def bound(self) -> int:
        """Place of the innermost element that others do not end; 0 for none."""
        return max(map(self.last, BOUNDS))

    def end(self, name: str) -> None:
        """A closing tag: the innermost element of its name closes; a leaf only inside the innermost bound."""
        at = self.last(name)
        if at and (name not in LEAVES or at >= self.bound()):
            self.cut(at)

    def begin(self, name: str) -> None:
        """An opening tag: the elements that it ends close, up to the innermost bound."""
        if self.stack[-1].name == "p":
            self.cut(len(self.stack) - 1)
        if name in ENDED:
            bound, ended = self.bound(), ENDED[name]
            after = [places[i] for n in ended if (places := self.places.get(n)) and (i := bisect_right(places, bound)) < len(places)]
            if after:
                self.cut(min(after))


class Element:
    """An open block element: its own marks; those of what it stands in count as well."""

    def __init__(self, name: str, chrome: bool, main: int, parent: "Element | None"):
        self.name, self.own, self.main, self.parent, self.known = name, chrome, main, parent, None

    def chrome(self) -> int:
        chain, e = [], self
        while e is not None and e.known is None:
            chain.append(e)
            e = e.parent
        value = e.known if e is not None else 0
        for e in reversed(chain):
            value = e.known = int(value or e.own)
        return value


def blocks(page: str) -> list[tuple[str, int, float, int, int, int]]:
    """(text, words, link density, chrome, main, heading) of every block with text, in page order.

    What holds the page's main element, or without any its first article, is not chrome.
    """
    page = visible(page)
    out: list = []
    top = Element("", False, 0, None)
    opened = Open(top)
    stack, pending = opened.stack, "main" if HOLDS_MAIN.search(page) else "article"
    text, linked, link_depth, heading = [], 0, 0, 0

    def flush() -> None:
        nonlocal linked
        plain = " ".join("".join(text).split())
        if plain:
            n = plain.count(" ") + 1
            out.append((plain, n, min(1.0, linked / n), stack[-1], stack[-1].main, heading))
        text.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            decoded = html.unescape(raw)
            text.append(decoded)
            if link_depth:
                linked += len(decoded.split())

    at = 0
    for found in TAG.finditer(page):
        add(page[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        closing = bool(found[1])
        if name == "a":
            link_depth = max(0, link_depth + (-1 if closing else 1))
        elif name == "br":
            text.append(" ")
        elif name not in INLINE:
            flush()
            link_depth = 0
            if re.fullmatch(r"h[1-6]", name):
                heading = 0 if closing else 1
            else:
                heading = 0
            if closing:
                opened.end(name)
                continue
            opened.begin(name)
            if name in CONTAINERS and not found[3].endswith("/") or name in LEAVES:
                names = " ".join(x for m in NAMED.findall(found[3]) for x in m if x)
                inside_main = stack[-1].main or int(name in ("article", "main") or bool(MAIN_NAMES.search(names)))
                is_chrome = bool(CHROME_NAMES.search(SAID_OF_PAGE.sub(" ", names)))
                if name in CHROME and not (name == "header" and stack[-1].main):
                    is_chrome = True
                opened.push(Element(name, is_chrome and name != "body", inside_main, stack[-1]))
                if name == pending:
                    pending = ""
                    for e in stack:
                        e.own = False
    add(page[at:])
    flush()
    return [(plain, n, links, e.chrome(), main, head) for plain, n, links, e, main, head in out]


def main_text(page: str | None, node) -> str:
    """The blocks that ``node`` takes for main text, joined by line breaks; empty for no page."""
    found = blocks(page) if page else []
    kept = []
    for i, (text, n, links, chrome, main, heading) in enumerate(found):
        before = found[i - 1][1:3] if i else (0, 0.0)
        after = found[i + 1][1:3] if i + 1 < len(found) else (0, 0.0)
        if decide(node, (n, links, *before, *after, chrome, main, heading)):
            kept.append(text)
    return "\n".join(kept)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    A null or empty page has empty text. Broken markup is read as far as it goes; pages are read whole and
    each for itself, so equal rows get equal results. Other columns are not read.
    """
    node = tree()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(p, node) for p in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    schema = "page_id string, url string, text string, n_chars long"
    return with_ids_as_text(pages.select("page_id", "url", "html"), run, schema, "page_id")
