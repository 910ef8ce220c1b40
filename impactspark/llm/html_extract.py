"""Main text of web pages by tag-path ratios.

A page is read once into blocks of text, each with the root-to-leaf path of
its open block elements (names with class and id).  Per path the text length
and the punctuation of all its blocks are added up and set against the
number of blocks and of linked characters.  The two ratios are smoothed with
those of the path's ancestors and descendants, fused by their geometric
mean and scaled by the unlinked share of the path's own text.  Paths that
reach a share of the page's weighted mean choose the content: the deepest
node that holds them all, or the ``article`` or ``main`` around it.  Below it
every path stays whose text is not mostly links, so plain lists, tables and
terms stay whatever the paragraphs beside them score.  What is never main
text goes by its element, class or id: menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments.  A class or id
does not count on what wraps the article or most of the page's text, nor does
a form (see ``Page._wrappers``); names of the site's furniture do not count
inside an article.  When a page
has an ``article`` or ``main`` element, only paths below one compete.

Character references are decoded, white space inside a block becomes one
space, blocks are joined in page order by one space.  Null or empty html and
pages without text give an empty text; broken or unclosed markup never
fails; each row gives one row, extra columns are kept; an empty table gives
an empty result.
"""

from __future__ import annotations

import html as references
import os.path
import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import released, without

#: Paths from this share of the page's mean score on choose the content node.
SHARE = 0.1
#: Below that node only paths with a larger linked share than this are dropped.
LINKED = 0.5

#: Fixed values of HTML: elements by what they mean here.
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre "
                  "section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg canvas title".split())
SKIP = frozenset("head nav footer aside menu button select dialog".split())
CLOSES_P = BLOCK - frozenset("br caption li dd dt legend option optgroup summary tbody td tfoot th thead tr title html body".split())
#: Elements that end open ones of the same kind, up to a boundary.
IMPLIED = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}),
           "td": ("td th", {"table"}), "th": ("td th", {"table"}), "option": ("option", {"select"})}
#: Words in a class or id that name what is not main text.
BAD = frozenset("ad ads advert adverts advertisement advertising adslot banner sponsor sponsored promo promotion nav navbar "
                "navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent notice notices alert "
                "popup modal comment comments commentlist reply replies disqus discussion share sharing social related "
                "recommended newsletter subscribe subscription signup login search widget pagination pager toolbar "
                "copyright legal disclaimer gdpr toc skip teaser".split())
#: Words of BAD that name the site's furniture; inside an article they are about its text.
FURNITURE = frozenset("legal search copyright disclaimer login signup toc pager pagination toolbar skip masthead gdpr".split())
#: Words of BAD that name what readers wrote, and words that turn a name into a property of a wrapper.
READERS = frozenset("comment comments commentlist reply replies disqus discussion".split())
PROPERTY = frozenset("has with without no not".split())
#: A wrapper leaves less than this share of its own text outside.
OUTSIDE = 0.1
#: Roles with the same meaning.
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I | re.S)
_NAME = re.compile(r"[a-z]+")
_HEADING = re.compile(r"/h[1-6](?:\[[^\]]*\])?$")
_PARAGRAPH = re.compile(r"/p(?:\[[^\]]*\])?$")
_INSIDE = re.compile(r".*/(?:article|main)(?:\[[^\]]*\])?(?=/|$)", re.S)
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")


def _signs(attributes: str) -> tuple[bool, set[str], str]:
    """Whether the attributes hide the element or give it such a role; the words of its class and id that name what
    is not main text ("" for one that is only a property, as in has-sidebar); class and id for the path."""
    if not attributes.strip():
        return False, set(), ""
    bad, named, label = False, set(), []
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = references.unescape(next((v for v in values if v), "")).lower()
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            bad = True
        elif name == "role":
            bad |= value.strip() in ROLES
        elif name in ("class", "id"):
            label.append(value)
            for part in value.split():
                names = _NAME.findall(part)
                named |= {"" if before in PROPERTY else w for before, w in zip(["", *names], names) if w in BAD or w == "header"}
    return bad, named, ".".join(label)


class Page:
    """Blocks ``(path, text, linked characters, skipped)`` of one page."""

    def __init__(self, source: str):
        self.stack: list[tuple[str, bool, str, tuple[int, ...]]] = [("", False, "", ())]  # element, skipped, path, named
        self.found: list[tuple[str, str, int, tuple[int, ...]]] = []  # blocks that no element, role or hidden skips
        self.named: list[set[str]] = []  # the words of each element that its class or id names
        self.holders: set[int] = set()  # those around an article or main
        self.parts: list[str] = []
        self.linked = 0
        self.links = 0
        self._read(source)
        skipped = set(range(len(self.named))) - self._wrappers()
        self.blocks = [(path, text, links, not skipped.isdisjoint(names)) for path, text, links, names in self.found]

    def _wrappers(self) -> set[int]:
        """Named elements that are the page's layout: they hold an article or main, or more than half of the text, and
        either the name is only a property of theirs or next to no other text stands outside all named elements (none
        for names of readers' comments); with an article or main outside those, only what is in it counts."""
        if not self.named:
            return set()
        size = [0] * len(self.named)
        for path, text, _, names in self.found:
            for k in names:
                if "form" not in self.named[k] or _PARAGRAPH.search(path):  # fields and labels do not make a form a layout
                    size[k] += len(text)
        half = sum(len(text) for _, text, _, _ in self.found) / 2
        free = [b for b in self.found if not b[3]]
        inside = [b for b in free if _INSIDE.match(b[0])]
        length, linked = defaultdict(int), defaultdict(int)
        for path, text, links, _ in inside or free:
            if not _HEADING.search(path):
                length[path] += len(text)
                linked[path] += min(links, len(text))
        outside = sum(n for path, n in length.items() if linked[path] <= LINKED * n)
        return {k for k, words in enumerate(self.named) if (k in self.holders or size[k] > half) and (
            words == {""} or outside <= (0 if words & READERS else OUTSIDE * size[k]))}

    def _flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                _, skipped, path, names = self.stack[-1]
                if not skipped:
                    self.found.append((path, text, self.linked, names))
            self.parts = []
        self.linked = 0

    def _open(self, name: str, attributes: str) -> None:
        bad, words, label = _signs(attributes)
        _, skipped, path, names = self.stack[-1]
        step = f"{name}[{label}]" if label else name
        inside = any(n in ("article", "main") for n, _, _, _ in self.stack)
        outer = name in ("html", "body", "main", "article")
        if inside:
            words -= FURNITURE | {"header"}
        if name == "form" and not bad:
            words.add("form")  # some sites wrap the whole page in one
        skip = skipped or bad and not outer or name == "header" and not inside or name in SKIP
        if words and not outer and not skip:
            names = (*names, len(self.named))
            self.named.append(words)
        if name in ("main", "article") and not skip:
            self.holders.update(names)
        self.stack.append((name, skip, f"{path}/{step}" if name in BLOCK else path, names))

    def _close(self, names: tuple[str, ...], until: frozenset | set = frozenset()) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] in names:
                del self.stack[k:]
                return
            if self.stack[k][0] in until:
                return

    def _text(self, text: str) -> None:
        if text and not self.stack[-1][1]:
            text = references.unescape(text)
            self.parts.append(text)
            if self.links:
                self.linked += len(text)

    def _read(self, source: str) -> None:
        at = 0
        while True:
            m = _TOKEN.search(source, at)
            if m is None:
                self._text(source[at:])
                break
            self._text(source[at:m.start()])
            at = m.end()
            name = m.group(2)
            if name is None:
                continue
            name, attributes = name.lower(), m.group(3) or ""
            if m.group(1):
                if name == "a":
                    self.links = max(0, self.links - 1)
                if name in BLOCK:
                    self._flush()
                if name not in VOID:
                    self._close((name,), {"article", "main", "table", "td"} - {name} if name not in ("html", "body") else set())
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                if name in ("title",):
                    self._flush()
                at = len(source) if end is None and name in ("script", "style", "textarea") else end.end() if end else at
                continue
            if name in BLOCK:
                self._flush()
                if name in CLOSES_P:
                    self._close(("p",), {"article", "main", "section", "div", "td", "li", "blockquote", "body", "button"})
                if name in IMPLIED:
                    names, until = IMPLIED[name]
                    self._close(tuple(names.split()), until)
            if name == "a" and not attributes.rstrip().endswith("/"):
                self.links = 1
            if name not in VOID and not (attributes.rstrip().endswith("/") and name not in BLOCK):
                self._open(name, attributes)
        self._flush()


def _scores(blocks: list[tuple[str, str, int, bool]]) -> dict[str, float]:
    """The fused, smoothed ratio of each path: text and punctuation for each block, less what is linked."""
    length, marks, count, linked = (defaultdict(float) for _ in range(4))
    for path, text, links, _ in blocks:
        length[path] += len(text)
        marks[path] += len(_PUNCTUATION.findall(text))
        linked[path] += min(links, len(text))
        count[path] += 1
    below: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0, 0.0])
    for path in count:
        node = path
        while node:
            total = below[node]
            for k, x in enumerate((length, marks, count, linked)):
                total[k] += x[path]
            node = node.rpartition("/")[0]
    out = {}
    for path in count:
        own = (length[path], marks[path], count[path], linked[path])
        parent = below[path.rpartition("/")[0]] if path.count("/") > 1 else own
        text = marksum = 0.0
        for (n, m, c, a), weight in ((own, 0.5), (parent, 0.5)):
            free = max(0.0, 1 - a / max(n, 1.0))
            text += weight * n / c * free
            marksum += weight * (m + 1) / c * free
        free = 1.0 if _HEADING.search(path) else max(0.0, 1 - own[3] / max(own[0], 1.0))
        out[path] = (text * marksum) ** 0.5 * free
    return out


def _kept(blocks: list[tuple[str, str, int, bool]]) -> set[str]:
    """The paths that score well, and the mostly unlinked ones below the node that holds those."""
    score = _scores(blocks)
    size = sum(len(t) for _, t, _, _ in blocks)
    mean = sum(score[p] * len(t) for p, t, _, _ in blocks) / size
    good = {p for p in score if score[p] >= SHARE * mean}
    steps = os.path.commonprefix([p.split("/")[:-1] for p in sorted(good)])
    node = "/".join(steps)
    around = _INSIDE.match(node)
    node = around.group() if around else node
    length, linked = defaultdict(int), defaultdict(int)
    for path, text, links, _ in blocks:
        length[path] += len(text)
        linked[path] += min(links, len(text))
    return good | {p for p in score if (p == node or p.startswith(node + "/"))
                   and (linked[p] <= LINKED * length[p] or _HEADING.search(p))}


def main_text(source: str | None) -> str:
    """The main text of one page."""
    if not source:
        return ""
    blocks = [b for b in Page(source).blocks if not b[3]]
    inside = [b for b in blocks if _INSIDE.match(b[0])]
    if inside:
        blocks = inside
    if not blocks:
        return ""
    kept = _kept(blocks)
    return " ".join(t for p, t, _, _ in blocks if p in kept)


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` without ``html``, with ``out``: the main text of each page."""
    pages = without(pages, out, keep=(html,))
    kept = [f for f in pages.schema.fields if f.name != html]
    names = [f.name for f in kept]
    source = pages.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{html}`"))

    @released
    def run(batches):
        for df in batches:
            texts = [main_text(x) if isinstance(x, str) else "" for x in df[html]]
            yield df[names].assign(**{out: pd.Series(texts, index=df.index, dtype=object)})

    return source.mapInPandas(run, T.StructType([*kept, T.StructField(out, T.StringType())]))
