"""Main text of web pages by consensus paths of their hosts.

First pass: every page is cut into its elements, parts that are never content are marked, and containers are scored by the
running text they hold. The best container of a page votes with its generalised path (tags and classes from the root, digits
left out) for its host; votes are counted in Spark. Second pass: pages meet the winning path of their host and are extracted
again from the elements on it; a page without such an element keeps its own best container.

Votes are summed before they are shuffled, and the winners are joined under a salt, so one host may own any share of the pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64

# Fixed values of HTML: elements without an end, elements whose content is not markup, and elements that stand as blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
BLOCKS = frozenset("html body address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section "
                   "summary table tbody td tfoot th thead tr ul".split())
# An element that begins ends an open one of these, up to the named borders.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
# Elements, and words in class, id or role, that mark what is not the article.
NOT_CONTENT = frozenset("head script style title textarea xmp iframe noembed noframes noscript template nav header footer aside button label "
                        "select svg canvas object dialog menu search".split())
NOT_CONTENT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments commentlist "
                              "consent cookie cookies copyright disclaimer discussion disqus footer gdpr header login masthead menu menus "
                              "modal nav navbar navigation navigator newsletter notice notices pager pagination paywall popup promo promos promotion related respond "
                              "replies reply search share sharing sidebar signup skip social sponsor sponsored sponsors subscribe subscription "
                              "tags toolbar topbar widget widgets".split())
LAYOUT_WORDS = frozenset("with has no without".split())

# A tag ends at its ">" outside quotes, else at the next "<" or ">"; every alternative fails within a few characters or consumes what
# it has read, so a page is read once whatever its markup. A comment without an end takes the rest.
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|"
                     r"<(/?)([a-zA-Z][^\s/<>]*+)(?:((?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)>|([^<>]*+)>?)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
_WORD = re.compile(r"[a-z]+")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!\s*important\s*)?(?:;|$)")


def attributes_of(text: str) -> dict[str, str]:
    """The attributes of a tag, names in lower case; one without a value is empty, of repeated ones the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def is_hidden(found: dict[str, str]) -> bool:
    return "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true" or bool(
        _UNSEEN.search(unescape(found.get("style", "")).lower()))


class Stack:
    """The open elements; it knows where each tag and the topmost block lie, so nothing is searched."""

    def __init__(self) -> None:
        self.elements: list[int] = [0]
        self.tags: list[str] = ["#root"]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, element: int, tag: str) -> None:
        at = len(self.elements)
        self.elements.append(element)
        self.tags.append(tag)
        self.places.setdefault(tag, []).append(at)
        if tag in BLOCKS:
            self.blocks.append(at)

    def last(self, tags: set[str]) -> int:
        """The topmost place of any of ``tags``; 0 where none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def cut(self, place: int) -> None:
        """Close what lies at ``place`` and above it."""
        while len(self.elements) > place:
            self.elements.pop()
            tag = self.tags.pop()
            self.places[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()


class Page:
    """The elements of a page in order: tag, parent, the step of its path, whether it is content; and its pieces of text by element."""

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.step, self.named, self.hidden = ["#root"], [-1], [""], [False], [False]
        self.pieces: list[tuple[int, str, int]] = []  # element, text, number of its block
        self.block = 0
        self._read(html)
        self._measure()

    def _open(self, tag: str, attributes: str, stack: Stack) -> None:
        found = attributes_of(attributes) if attributes else {}
        names = [re.sub(r"\d+", "", c) for c in found.get("class", "").lower().split()]
        said = " ".join(found.get(a, "") for a in ("class", "id", "role")).lower().split()
        self.tag.append(tag)
        self.parent.append(stack.elements[-1])
        self.step.append(f"/{tag}{''.join('.' + n for n in sorted(n for n in names if n))}")
        # A form may hold the article, as one with a name that speaks against it may.
        self.named.append(tag == "form" or any(not NOT_CONTENT_WORDS.isdisjoint(w) and LAYOUT_WORDS.isdisjoint(w) for w in map(_WORD.findall, said)))
        self.hidden.append(tag in NOT_CONTENT or bool(found) and is_hidden(found))
        stack.push(len(self.tag) - 1, tag)

    def path(self, element: int) -> str:
        steps = []
        while element > 0:
            steps.append(self.step[element])
            element = self.parent[element]
        return "".join(reversed(steps))

    def on(self, path: str) -> set[int]:
        """The elements whose path is ``path``: each goes on from how far its parent's path has matched."""
        reach, found = [0], set()
        for i in range(1, len(self.tag)):
            at = reach[self.parent[i]]
            reach.append(at + len(self.step[i]) if at >= 0 and path.startswith(self.step[i], at) else -1)
            if reach[i] == len(path):
                found.add(i)
        return found

    def _read(self, html: str) -> None:
        stack, at, end = Stack(), 0, len(html)
        while at < end:
            m = _MARKUP.search(html, at)
            if m is None:
                self._text(html[at:], stack)
                return
            self._text(html[at:m.start()], stack)
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                self._close(tag, stack)
                continue
            self._make_room(tag, stack)
            attributes = m[3] or m[4] or ""
            if tag in BLOCKS:
                self.block += 1
            if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
                if tag == "br":
                    self._text(" ", stack)
                continue
            self._open(tag, attributes, stack)
            if tag in RAW:
                close = re.compile(f"</{tag}", re.I).search(html, at)
                at = html.find(">", close.end()) + 1 or end if close else end
                stack.cut(len(stack.elements) - 1)

    def _make_room(self, tag: str, stack: Stack) -> None:
        """End what the start of ``tag`` ends without saying so."""
        closing, border = CLOSES.get(tag, (None, None))
        if closing:
            place = stack.last(closing)
            if place and place > stack.last(border):
                stack.cut(place)
        if tag in BLOCKS and stack.blocks and stack.tags[stack.blocks[-1]] == "p":
            stack.cut(stack.blocks[-1])

    def _close(self, tag: str, stack: Stack) -> None:
        if tag in BLOCKS:
            self.block += 1
        place = stack.last({tag})
        # The end of an inline element does not end the block around it.
        if place and (tag in BLOCKS or not stack.blocks or place > stack.blocks[-1]):
            stack.cut(place)

    def _text(self, text: str, stack: Stack) -> None:
        if text:
            self.pieces.append((stack.elements[-1], text, self.block))

    def _measure(self) -> None:
        """Which elements are no content, and the running text under the others."""
        n = len(self.tag)
        linked = [False] * n
        for i in range(1, n):
            linked[i] = linked[self.parent[i]] or self.tag[i] == "a"
        # The article itself may lie in an element whose class names something else, or in a form around the whole page.
        holds = [t in ("article", "main", "h1") for t in self.tag]
        under, own = [0] * n, [0] * n
        for element, text, _ in self.pieces:
            if self.tag[element] not in RAW:
                own[element] += len(text.strip())
        sum_of_all = sum(own)
        for i in range(n - 1, -1, -1):
            under[i] += own[i]
            if i:
                under[self.parent[i]] += under[i]
                holds[i] |= self.tag[i] == "form" and 2 * under[i] > sum_of_all
                holds[self.parent[i]] |= holds[i] and not self.hidden[i]
        self.out = [False] * n
        for i in range(1, n):
            self.out[i] = self.out[self.parent[i]] or self.hidden[i] or self.named[i] and not holds[i]
        # Running text: what lies outside links, counted in its own element.
        self.score = [0.0] * n
        for element, text, _ in self.pieces:
            size = len(text.strip())
            if size and not self.out[element]:
                self.score[element] += size if not linked[element] else -size
        for i in range(n - 1, 0, -1):
            self.score[self.parent[i]] += max(0.0, self.score[i])

    def best(self) -> int:
        """The innermost container that holds nine tenths of the page's running text."""
        at, children = 0, {}
        for i in range(1, len(self.tag)):
            children.setdefault(self.parent[i], []).append(i)
        least = 0.9 * self.score[0]
        while least > 0:
            inner = [i for i in children.get(at, ()) if not self.out[i] and self.score[i] >= least and self.tag[i] in BLOCKS]
            if not inner or self.tag[inner[0]] in ("p", "pre", "li"):
                break
            at = inner[0]
            if self.tag[at] == "article":
                break
        return at

    def extract(self, path: str | None) -> str:
        """The text of the elements on ``path``, else of the page's own best container; one line for each block."""
        inside = [False] * len(self.tag)
        roots = {i for i in self.on(path) if not self.out[i] and self.score[i] > 0} if path else set()
        roots = roots or {self.best()}
        lines, block = [], None
        for i in range(len(self.tag)):
            inside[i] = (i in roots or i > 0 and inside[self.parent[i]]) and not self.out[i]
        for element, text, number in self.pieces:
            if inside[element]:
                if number != block:
                    lines.append([])
                    block = number
                lines[-1].append(unescape(text) if "&" in text else text)
        return "\n".join(line for line in (" ".join("".join(parts).split()) for parts in lines) if line)


def host_of(url: Column) -> Column:
    """Host of a URL in lower case without ``www.``; empty where there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    return F.regexp_replace(host, r"^www\.", "")


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path, votes: the path that most pages of a host name; ties go to more running text, then to the smaller path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, scores = [], [], []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page = Page(html)
                at = page.best()
                if at and page.score[at] > 0:
                    hosts.append(host)
                    paths.append(page.path(at))
                    scores.append(int(page.score[at]))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.int64())],
                                             ["host", "path", "score"])

    votes = pages.filter("html IS NOT NULL").select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(
        run, "host string, path string, score long").groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("score").alias("score"))
    best = F.min(F.struct((-F.col("votes")).alias("v"), (-F.col("score")).alias("s"), "path")).alias("best")
    return votes.groupBy("host").agg(best).select("host", "best.path", (-F.col("best.v")).alias("votes"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points), path (its host's; null without one).

    A null or empty html gives an empty text. Pages without a host in their url vote together. Repeated pages vote as often as
    they occur and are extracted one by one; columns beyond page_id, url and html are not read.
    """
    winners = host_paths(pages).select("host", "path", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"),
                        F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(SALTS)).cast("int").alias("salt"))
    joined = rows.join(winners, ["host", "salt"], "left").select("page_id", "url", "html", "path")
    types = dict(joined.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(h).extract(p) if h else "" for h, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array(list(map(len, texts)), pa.int64()), batch.column(3)],
                                             ["page_id", "url", "text", "n_chars", "path"])

    return joined.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long, path string")


