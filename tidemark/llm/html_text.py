"""Main text of web pages by tree scoring.

A page is read once into a tree of its block elements. Every block of text is a
paragraph that passes points (one, one more for each comma and for each hundred
characters, less its share of link text) to the element around it, half of them
to the next one and a falling share further up. An element's score is its
points and the weight of its class and id, times the share of its text that is
no link. The best container and the siblings that score a fifth of it or more
are kept, without what is no article inside them: menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments, known
by element, role, or class and id.

Text: character references decoded, white space inside a block turned into one
space and trimmed, blocks joined in page order by one newline. Inline markup
does not part words; ``<br>`` is white space and two of them part blocks. An
article's own headline (h1 to h6, also inside its header) is part of the text.

A page whose elements are all ruled out is read again with forms, then also
with elements of any class: a wrapper's name must not hide a whole page.

Edge cases: a null or empty page, or one without any text, gives an empty
text. Unclosed elements end with the element around them, unclosed comments,
scripts and styles with the page, as browsers have it; ``<`` before no letter is
text. Every row yields one row, repeated ones too; page_id and url are passed
on as they are, whatever their types. Extra columns are not read. Time grows linearly with the
length of a page and memory is that of one slice of a record batch, or of one page.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm.common import ship, slices

# Elements of HTML by what they mean for a text, and names that mark what is no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER = frozenset("aside audio button canvas datalist dialog footer label menu meter nav object output progress "
                  "search select svg template video".split())
BLOCKS = HEADINGS | NEVER | frozenset(
    "address article blockquote body caption center dd details dir div dl dt fieldset figcaption figure form header "
    "hgroup hr html legend li listing main ol optgroup option p pre section summary table tbody td tfoot th thead "
    "tr ul".split())
SCOPES = frozenset("ul ol dl menu table td th caption select".split())
#: A start tag ends an open element of these kinds.
ENDS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"},
        "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"}}
CELLS = frozenset("tr td th tbody tfoot".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search".split())
OTHERS_WORDS = frozenset(
    "ad ads adsense adslot adv advert advertisement advertising advertorial adverts comment commentlist comments "
    "disqus discussion promo promos promoted promotion replies reply respond sponsor sponsored sponsors".split())
NO_ARTICLE = OTHERS_WORDS | frozenset(
    "alert aside breadcrumb breadcrumbs consent cookie cookies copyright disclaimer footer form gdpr legal lightbox "
    "login menu menubar modal nav navbar navigation newsletter notice notices overlay pager pagination paginator "
    "paywall popup privacy rail recommendation recommendations recommended register related search searchbox share "
    "sharing sidebar signin signup skip skiplink social submenu subscribe subscription toolbar topbar trending "
    "widget widgets".split())
HEADER_NAMES = frozenset("header masthead".split())
ARTICLE_NAMES = frozenset("article blog body content entry hentry main page post story text".split())
NOT_A_NAME = frozenset("has hide is js no non not sans show with without".split())
COMMAS = re.compile("[,،、，]")

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])))*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop|style|hidden)(?=[\s=/]|$)"
                        r"(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"']++)))?", re.I)
_NAME_WORDS = re.compile("[A-Z]?[a-z]+|[A-Z]+")

DROPPED, HEADER, FORM = 1, 2, 4


@lru_cache(maxsize=4096)
def _named(attributes: str, tag: str) -> tuple[int, int, bool]:
    """What an element's attributes say: flags, weight, whether it is marked as the article's body."""
    flags = weight = 0
    body = False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            flags |= DROPPED
        elif name == "role" and value.lower() in ROLES:
            flags |= HEADER if value.lower() == "banner" else DROPPED
        elif name == "itemprop" and value.lower() == "articlebody":
            body = True
        elif name in ("class", "id"):
            for one in value.split():
                words = [w.lower() for w in _NAME_WORDS.findall(one)]
                if not words or words[0] in NOT_A_NAME:
                    continue
                ends = {words[0], words[-1]}
                if ends & (OTHERS_WORDS if tag in ("article", "main") else NO_ARTICLE):
                    flags |= DROPPED
                elif ends & HEADER_NAMES and tag not in HEADINGS:
                    flags |= HEADER
                elif ARTICLE_NAMES & set(words):
                    weight = 25
    return flags, weight, body


class Tree:
    """Block elements of a page in page order (a parent before its children) and its blocks of text."""

    def __init__(self, page: str, names: bool, forms: bool):
        self.names, self.forms = names, forms
        self.parent, self.tag, self.flags, self.weight = [-1], ["#page"], [0], [0]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters of links
        self.nested = [False]  # has block elements inside
        self._open: list[tuple[str, int]] = [("#page", 0)]  # inline links are open elements too
        self._count: Counter[str] = Counter()
        self._scopes: list[tuple[str, Counter[str]]] = [("#page", Counter())]
        self._buffer: list[str] = []
        self._links = 0
        self._breaks = 0
        self._read(page)
        self._flush()

    def _read(self, page: str) -> None:
        at, end, last, tags = 0, len(page), page.rfind(">"), _TAG
        while at < end:
            start = page.find("<", at)
            if start < 0:
                self._text(page[at:])
                return
            if start > at:
                self._text(page[at:start])
            if page.startswith("<!--", start):
                close = page.find("-->", start + 2)  # <!--> is a whole comment
                if close < 0:
                    return
                at = close + 3
                continue
            after = page[start + 1:start + 2]
            if after in ("!", "?") or after == "/" and not page[start + 2:start + 3].isalpha():
                close = page.find(">", start)
                if close < 0:
                    return
                at = close + 1
                continue
            if not (after == "/" or after.isascii() and after.isalpha()):
                self._text("<")
                at = start + 1
                continue
            if start > last:
                return  # a tag that the page's end cuts off
            m = tags.match(page, start)
            if m is None:
                if tags is _TAG:
                    tags = _PLAIN_TAG  # an unclosed quote: from here on tags end at the next >
                    m = tags.match(page, start)
                if m is None:
                    self._text("<")
                    at = start + 1
                    continue
            at = m.end()
            tag = m[2].lower()
            if m[1]:
                self._end(tag)
            elif tag in RAW:
                close = _raw_end(tag).search(page, at)
                if close is None:
                    return
                at = close.start()
            else:
                self._start(tag, m[3])

    def _text(self, text: str) -> None:
        if self.flags[self._open[-1][1]] & DROPPED:
            return
        if "&" in text:
            text = html.unescape(text)
        if not text.isspace():
            self._breaks = 0
        self._buffer.append(text)
        if self._count["a"]:
            self._links += len(text.strip())

    def _flush(self) -> None:
        self._breaks = 0
        if self._buffer:
            text = " ".join("".join(self._buffer).split())
            if text:
                self.blocks.append((self._open[-1][1], text, min(self._links, len(text))))
            self._buffer, self._links = [], 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._buffer.append("\n")
            self._breaks += 1
            if self._breaks == 2:
                self._flush()
            return
        if tag not in BLOCKS:
            if tag == "a" and "href" in attributes.lower():
                if self._count["a"] and self._open[-1][0] == "a":
                    self._pop()
                self._push("a", self._open[-1][1])
            return
        self._flush()
        if tag in CELLS:
            if self._count["table"]:
                while self._scopes[-1][0] != "table":
                    self._pop()
        scope = self._scopes[-1][1]
        for kind in ENDS.get(tag, ()):
            while scope[kind] and self._scopes[-1][1] is scope:
                self._pop()
        while scope["p"]:
            self._pop()
        if tag in VOID:
            return
        up = self._open[-1][1]
        flags = self.flags[up]
        weight, body = 0, False
        if attributes and tag not in ("html", "body"):
            named, weight, body = _named(attributes, tag)
            if self.names:
                flags |= named
        if tag in NEVER:
            flags |= DROPPED
        elif tag == "header":
            flags |= HEADER
        elif tag == "form" and not self.forms:
            flags |= DROPPED
        self.nested[up] = True
        self.parent.append(up)
        self.tag.append("article" if body else tag)
        self.flags.append(flags)
        self.weight.append(weight)
        self.nested.append(False)
        self._push(tag, len(self.tag) - 1)

    def _push(self, tag: str, node: int) -> None:
        self._open.append((tag, node))
        self._count[tag] += 1
        self._scopes[-1][1][tag] += 1
        if tag in SCOPES:
            self._scopes.append((tag, Counter()))

    def _pop(self) -> None:
        tag, _ = self._open[-1]
        if tag != "a":
            self._flush()
        self._open.pop()
        self._count[tag] -= 1
        if tag in SCOPES:
            self._scopes.pop()
        self._scopes[-1][1][tag] -= 1

    def _end(self, tag: str) -> None:
        if tag in BLOCKS or tag == "a":
            if tag != "a":
                self._flush()
            if not self._count[tag] or tag in ("html", "body") or tag == "a" and self._open[-1][0] != "a":
                return  # nothing to end; a link around blocks ends with the element around it
            while self._open[-1][0] != tag:
                self._pop()
            self._pop()


@lru_cache(maxsize=16)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])", re.I)


def _points(tree: Tree) -> tuple[list[float], list[int], list[int]]:
    """Points, characters and link characters by element."""
    n = len(tree.tag)
    points, chars, links = [0.0] * n, [0] * n, [0] * n
    for node, text, linked in tree.blocks:
        chars[node] += len(text)
        links[node] += linked
        tag = tree.tag[node]
        if tag in HEADINGS or tree.flags[node] & HEADER:
            continue
        score = (1 + len(COMMAS.findall(text)) + len(text) / 100) * (1 - linked / len(text))
        own = tree.nested[node] or tag in ("article", "main", "section", "body", "html", "#page")
        at = node if own else tree.parent[node]
        for level in range(5):
            if at < 0:
                break
            points[at] += score / (1, 2, 6, 9, 12)[level]
            at = tree.parent[at]
    for node in range(n - 1, 0, -1):
        chars[tree.parent[node]] += chars[node]
        links[tree.parent[node]] += links[node]
    return points, chars, links


_TAG_WEIGHT = {"div": 5, "pre": 3, "td": 3, "blockquote": 3, "address": -3, "ol": -3, "ul": -3, "dl": -3, "dd": -3,
               "dt": -3, "li": -3, "form": -3, "th": -5}
_ROOTS = ("#page", "html", "body")
_TEXT_TAGS = frozenset("p pre blockquote ul ol dl table figure".split())


def _kept(tree: Tree) -> list[bool]:
    """The best container and its siblings, as elements to keep with all that is inside."""
    n, parent, tag = len(tree.tag), tree.parent, tree.tag
    points, chars, links = _points(tree)
    thin = lambda i: links[i] / chars[i] if chars[i] else 0.0  # noqa: E731  link density
    scores = [(points[i] + _TAG_WEIGHT.get(tag[i], 0) + tree.weight[i]) * (1 - thin(i)) if points[i] else 0.0
              for i in range(n)]
    keep = [False] * n
    inside = [i for i in range(n) if points[i] > 0]
    if inside:
        best = max(inside, key=lambda i: (scores[i], -i))
        last = scores[best]
        while tag[best] not in _ROOTS and tag[parent[best]] not in _ROOTS:
            up = scores[parent[best]]
            if up < last * 0.75:
                break
            best = parent[best]
        around, at = None, best
        while at >= 0:
            if tag[at] == "article" or tag[at] == "main" and around is None:
                around = at
            at = parent[at]
        if around is not None:
            best = around
    else:  # headings only
        best = next((i for i in range(n) if tag[i] == "article"), next((i for i in range(n) if tag[i] == "main"), 0))
    keep[best] = True
    article = tag[best] in ("article", "main")
    if best and inside:
        top = scores[best]
        for i in range(1, n):
            if parent[i] != parent[best] or i == best or not chars[i] or tree.flags[i] & (DROPPED | HEADER):
                continue
            if article:
                keep[i] = tag[i] == tag[best] and scores[i] >= 0.2 * top
            else:
                keep[i] = (tag[i] in HEADINGS or scores[i] >= 0.2 * top
                           or tag[i] in _TEXT_TAGS and thin(i) < 0.25 and chars[i] > 80)
    for i in range(1, n):
        if keep[parent[i]] and not keep[i]:
            lists = not article and tag[i] not in ("p", "td", "li") and tag[i] not in HEADINGS
            keep[i] = not (lists and thin(i) > 0.66 and chars[i])
    if tag[best] in _ROOTS:
        for i in range(n):  # a page's own header, not an article's
            keep[i] = keep[i] and not tree.flags[i] & HEADER
    return keep


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    for names, forms in ((True, False), (True, True), (False, True)):
        tree = Tree(page, names, forms)
        if not tree.blocks:
            continue
        keep = _kept(tree)
        text = "\n".join(t for node, t, _ in tree.blocks
                         if keep[node] and (not tree.flags[node] & HEADER or tree.tag[node] in HEADINGS))
        if text:
            return text
    return ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    ship(pages.sparkSession)
    fields = [pages.schema["page_id"], pages.schema["url"]]
    out = StructType([*fields, StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 4 << 20):
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, out)
