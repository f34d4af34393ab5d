"""Main text of web pages (operator 3).

A streaming pass over the events of the standard library's HTML parser cuts a page into lines,
one per block element, and counts the characters and tags of each.  The text-to-tag ratios are
smoothed along the page with a Gaussian kernel and split into two clusters by a threshold; the lines
above it are content.

Where most content lies in articles and main parts, the article with most content is the article
proper.  Of a main part around it every line is kept, headings, leads and short articles included; without
one, every line of all articles at the same path of tags.  Readers' comments and teasers are left out by their
place: a list or division after the article that holds articles at another path, a list of
items after it, a list or division inside it with several articles.  Elsewhere the page regions (the nearest main, section,
division, cell or body) that hold mostly content lines are chosen, and the smallest block around them (around a
lone one, its parent) is the article, but for regions of links and articles before and after them.

Elements and names that mark menus, headers, footers, sidebars, notices, adverts, forms and reader
comments are skipped first.  A name marks if it consists of words of ``MARKS`` and plain words only.  It
marks neither articles nor main parts, nor what holds all of these, nor what holds most of the
page's text outside links (comments and what stands beside an article may); where a mark turns out
to be wrong, the page is parsed a second time without it.  So is a page with an unclosed nav around its article.

The work is map-only, one page at a time, so memory is bounded by the largest page and time by its
length: closing a tag doesn't search the stack.  Defined
cases: NULL or empty html, and a page without text, give an empty text; unclosed and stray tags
are closed as browsers do; a tag or comment cut off by the end of the page is dropped with what it would
hold; an open head ends at what cannot stand in it; white space of any kind counts; repeated rows give equal results; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML elements by their part in a page.
SKIPPED = frozenset("head title script style noscript template nav footer aside form button select textarea option iframe "
                    "svg canvas object menu dialog audio video map math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary "
                   "table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript template noframes".split())
REGIONS = frozenset("article main section div td body html".split())
NODES = REGIONS | frozenset("ul ol li nav".split())
HOLDERS = frozenset("section div ul ol".split())  # of repeated articles and items
# What ends an open paragraph's reach, and of items, rows and cells their like and what ends its reach.
P_BOUNDS = tuple("td th li div article section blockquote".split())
ENDED_BY = {"li": (("li",), ("ul", "ol", "menu")), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")),
            "th": (("th", "td"), ("tr", "table")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dd", "dt"), ("dl",))}
# Words of class, id and role values that mark other than article text.
MARKS = frozenset("ad ads adsbygoogle adsense advert advertisement adverts advertising alert alerts banner breadcrumb "
                  "breadcrumbs comment comments complementary contentinfo cookie cookies consent discussion discussions "
                  "disqus footer masthead menu modal nav navbar navigation newsletter notice notification overlay "
                  "pagination paywall popup promo promoted recommended related replies respond search share sharing "
                  "sidebar signup social sponsor sponsored subscribe toolbar widget".split())
HEADERS = frozenset(["header", "pageheader", "siteheader", "topbar"])  # article headers stay
READERS = frozenset(["comment", "comments", "discussion", "discussions", "disqus", "replies", "respond"])
# Words that may stand beside those of MARKS in a name, and beside those of HEADERS.
PLAIN = frozenset("area article bar block blog bottom box btn button buttons center col column container content "
                  "entry form global group icons inner item items left link links list local main media message messages outer "
                  "page panel policy post posts primary right secondary section site slot story stories thread top "
                  "unit web wrap wrapper".split())
PLAIN_HEADERS = frozenset("bar block container global inner main page site top web wrap wrapper".split())
TAG_START = re.compile("<[A-Za-z/!?]")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

SIGMA = 1.0     # of the smoothing, in lines
REACH = 2       # lines on either side
ARTICLE = 0.25  # share of the text beside it that an article in a main part must have to be the article proper
MAJORITY = 0.5  # share of a region's characters that must be in content lines, or of a page's that a mark may drop


@lru_cache(maxsize=4096)
def _parts(name: str) -> frozenset[str]:
    """Words of one name in lower case; a word made of two known ones, one of them a mark, counts as both."""
    words = {w.lower() for w in NAME_PARTS.findall(name) if not w.isdigit()} | {name.lower()} & (MARKS | HEADERS)
    if name.lower() in words & (MARKS | HEADERS):
        return frozenset([name.lower()])
    out: set[str] = set()
    for word in words:
        pairs = [] if len(word) > 40 or word in MARKS | HEADERS | PLAIN else [
            (word[:i], word[i:]) for i in range(2, len(word) - 1)]
        out |= next(({a, b} for a, b in pairs if {a, b} & MARKS and {a, b} <= MARKS | PLAIN), {word})
    return frozenset(out)


def _marks(value: str, inside: bool) -> tuple[bool, bool]:
    """Whether a class, id or role marks other than article text, and whether by readers."""
    marked = readers = False
    for name in value.split():
        words = _parts(name)
        if words & MARKS and words <= MARKS | PLAIN or (
                not inside and words & HEADERS and words <= HEADERS | MARKS | PLAIN_HEADERS):
            marked, readers = True, readers or bool(words & READERS)
    return marked, readers


class _Lines(HTMLParser):
    """Collects lines as (text, tags, region, node).

    Every tag's places on the stack of open elements are kept, so that closing one doesn't search it.
    """

    def __init__(self, ignored: frozenset[int] = frozenset(), short_nav: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        # tag, skipped, region, inside an article or main, skipped whatever the marks, mark around, inside a link,
        # inside an article, node
        self.open: list[tuple[str, bool, int, bool, bool, int, bool, bool, int]] = []
        self.places: dict[str, list[int]] = defaultdict(list)  # of each tag on the stack
        self.blocks: list[int] = []                            # of all block tags
        self.ignored = ignored      # marks that mark nothing
        self.short_nav = short_nav  # whether an article or main ends an open nav
        self.uncommented = False    # whether a comment has no end
        self.lost = False           # whether a nav held one and wasn't closed by its own tag
        # Nodes are the elements of ``NODES``, 0 for the page: tag, node around, path of tags, last node inside, region,
        # and of lists and divisions how many articles (in items, too) and items they hold.
        self.tag, self.outer, self.path, self.last, self.region = [""], [0], [0], [0], [0]
        self.n_articles, self.n_items = [0], [0]
        self.paths: dict[tuple[int, str], int] = {}
        # Of each mark, 0 for the page: mark around it, whether by readers or beside the articles; characters
        # outside links, all of them and those in an article or main, and the outermost articles and main parts.
        self.around, self.beside, self.held, self.prose, self.articles = [0], [False], [0], [0], [0]
        self.parents = [0]  # of each region, 0 for the page; regions are numbered as they start
        self.linked = [0]   # characters of its links, headings aside
        self.lines: list[tuple[str, int, int, int]] = []
        self.parts: list[str] = []
        self.tags = 0

    def _top(self) -> tuple[bool, int, bool, bool, int, bool, bool, int]:
        return self.open[-1][1:] if self.open else (False, 0, False, False, 0, False, False, 0)

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            top = self._top()
            self.lines.append((text, max(self.tags, 1), top[1], top[7]))
        self.parts, self.tags = [], 0

    def _place(self, tag: str) -> int:
        """Of the innermost open ``tag`` on the stack, -1 without one."""
        places = self.places.get(tag)
        return places[-1] if places else -1

    def _close_from(self, place: int, by: str = "") -> None:
        """Closes the open elements from ``place`` on; ``by`` is the end tag that does."""
        while len(self.open) > place:
            element = self.open.pop()
            tag, node = element[0], element[8]
            self.places[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()
            if tag in NODES:
                self.last[node] = len(self.tag) - 1
            if tag == "nav" and by != "nav" and self.n_articles[node]:
                self.lost = True

    def close(self) -> None:
        # What has no end tag bracket can't become a tag any more; it is dropped as browsers do, not searched again.
        cut = TAG_START.search(self.rawdata, self.rawdata.rfind(">") + 1)
        if cut and not self.cdata_elem:
            self.rawdata = self.rawdata[:cut.start()]
        super().close()
        self._flush()
        self._close_from(0)

    def parse_comment(self, i: int, report: bool = True) -> int:
        """Once a comment isn't closed, none after it is: it isn't searched for again."""
        k = -1 if self.uncommented else super().parse_comment(i, report)
        self.uncommented = k < 0
        return k

    def parse_marked_section(self, i: int, report: bool = True) -> int:
        return self.parse_bogus_comment(i, report)

    def _node(self, tag: str, around: int, region: int) -> int:
        """A new node for an element."""
        path = self.paths.setdefault((self.path[around], tag), len(self.paths) + 1)
        for of, value in ((self.tag, tag), (self.outer, around), (self.path, path), (self.last, 0), (self.region, region),
                          (self.n_articles, 0), (self.n_items, 0)):
            of.append(value)
        if tag == "li":
            self.n_items[around] += 1
        if tag in ("article", "main"):
            holder = self.outer[around] if self.tag[around] == "li" else around
            self.n_articles[holder] += 1
        return len(self.tag) - 1

    def _hidden(self, attrs: list[tuple[str, str | None]]) -> bool:
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            elif name == "style" and value and "display:none" in value.replace(" ", "").lower():
                return True
        return False

    def _mark(self, attrs: list[tuple[str, str | None]], inside: bool, mark: int) -> int:
        """The number of a new mark inside ``mark`` if a name marks the element, else ``mark``."""
        marked = readers = False
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                found = _marks(value, inside)
                marked, readers = marked or found[0], readers or found[1]
        if not marked:
            return mark
        for of, value in ((self.around, mark), (self.beside, readers or not inside), (self.held, 0), (self.prose, 0),
                          (self.articles, 0)):
            of.append(value)
        return len(self.around) - 1

    def wrong_marks(self) -> frozenset[int]:
        """Marks around all articles and main parts, or around most of the text."""
        held, prose, articles = list(self.held), list(self.prose), list(self.articles)
        for m in range(len(held) - 1, 0, -1):
            for of in (held, prose, articles):
                of[self.around[m]] += of[m]
        return frozenset(
            m for m in range(1, len(held)) if articles[m] and articles[m] == articles[0]
            or held[m] > MAJORITY * held[0] and not (self.beside[m] and prose[0] > prose[m]))

    def _close_head(self) -> None:
        """Closes an open head, and what was left open in it."""
        if self._place("head") >= 0:
            self._close_from(self._place("head"))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body" or tag not in IN_HEAD and self.open and self.open[-1][0] == "head":
            self._close_head()
        if self.short_nav and tag in ("article", "main") and self._place("nav") >= 0:
            self._close_from(self._place("nav"))
        if tag in BLOCKS:
            self._flush()
            self._close_implied(tag)
        skipped, region, inside, hard, mark, linked, article, node = self._top()
        if not skipped:
            self.tags += 1
        if tag in VOID:
            if tag in ("br", "hr"):
                self.parts.append(" ")
            return
        if tag in ("html", "body"):  # their names style the page, they do not mark a part of it
            attrs = []
        hard = hard or tag in SKIPPED or tag == "header" and not inside or self._hidden(attrs)
        top = tag == "main" or tag == "article" and not article
        if not hard and not top:
            around, mark = mark, self._mark(attrs, inside, mark)
            skipped = skipped or mark != around and mark not in self.ignored
        skipped = skipped or hard
        if tag in ("article", "main"):
            self.articles[mark] += not hard and not inside
        if tag in ("article", "main") or tag in REGIONS and not inside:
            self.parents.append(region)
            self.linked.append(0)
            region = len(self.parents) - 1
        if tag in NODES:
            node = self._node(tag, node, region)
        self.places[tag].append(len(self.open))
        if tag in BLOCKS:
            self.blocks.append(len(self.open))
        self.open.append((tag, skipped, region, inside or tag in ("article", "main"), hard, mark,
                          linked or tag == "a", article or tag == "article", node))

    def _close_implied(self, tag: str) -> None:
        """A block ends an open paragraph; items, rows and cells end their like."""
        for like, bounds in (("p",), P_BOUNDS), ENDED_BY.get(tag, ((), ())):
            place = max((self._place(t) for t in like), default=-1)
            if place > max((self._place(t) for t in bounds), default=-1):
                self._close_from(place)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        if not self._top()[0]:
            self.tags += 1
        place = self._place(tag) if tag not in VOID else -1
        # a stray inline end tag does not close blocks
        if place >= 0 and (tag in BLOCKS or not self.blocks or self.blocks[-1] < place):
            self._close_from(place, by=tag)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] == "head" and not data.isspace():
            self._close_head()
        skipped, region, inside, hard, mark, linked, _, _ = self._top()
        if not skipped:
            self.parts.append(data)
            if linked and not any(x[0] in HEADINGS for x in self.open[-3:]):
                self.linked[region] += len(" ".join(data.split()))
        if not hard and not linked:
            size = len("".join(data.split()))
            self.held[mark] += size
            self.prose[mark] += size if inside else 0


def smooth(values: list[float], sigma: float = SIGMA, reach: int = REACH) -> list[float]:
    """Gaussian smoothing; at the ends the kernel is cut and renormalised."""
    weights = [math.exp(-k * k / (2 * sigma * sigma)) for k in range(reach + 1)]
    out = []
    for i in range(len(values)):
        near = range(max(0, i - reach), min(len(values), i + reach + 1))
        total = sum(weights[abs(i - j)] for j in near)
        out.append(sum(values[j] * weights[abs(i - j)] for j in near) / total)
    return out


def threshold(values: list[float]) -> float:
    """The midpoint between the means of two clusters of ``values``, moved until it stays."""
    cut = (min(values) + max(values)) / 2
    for _ in range(50):
        low = [v for v in values if v < cut]
        high = [v for v in values if v >= cut]
        if not low:
            return min(high)
        moved = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if moved == cut:
            break
        cut = moved
    return cut


def _block(chosen: set[int], parents: list[int], links: set[int]) -> set[int]:
    """The regions of the smallest block around ``chosen``, without those of ``links`` that stand
    before the first or after the last of ``chosen``."""
    first, last = min(chosen), max(chosen)
    top, other = first, last
    while top != other:  # a region has a larger number than those around it
        top, other = min(top, other), parents[max(top, other)]
    if first == last:
        top = parents[top]
    inside = {top}
    for region in range(top + 1, len(parents)):
        if parents[region] in inside:
            inside.add(region)
    return {r for r in inside if r in chosen or r not in links or first < r < last}


def _article_nodes(page: _Lines, content: dict[int, int]) -> list[bool]:
    """Which nodes are of the article, where articles or main parts hold the content.

    The article proper is the one with most content.  A main part around it is taken whole, otherwise
    all articles at the same path of tags, however short.  Readers' comments and teasers go by their
    place: lists and divisions after the article that hold articles at another path or items, and
    lists and divisions inside it with several articles.
    """
    n = len(page.tag)
    own = [v for v in range(n) if page.tag[v] in ("article", "main")]
    whole, outside = [content.get(v, 0) for v in range(n)], [content.get(v, 0) for v in range(n)]
    for v in range(n - 1, 0, -1):  # of all inside, and of what is inside but not in articles
        whole[page.outer[v]] += whole[v]
        outside[page.outer[v]] += outside[v] if page.tag[v] != "article" else 0
    # a main part counts by what it holds beside its articles; there one of them may be long
    best = max(own, key=lambda v: (whole[v] if page.tag[v] == "article" else ARTICLE * outside[v], -v))
    around = {best}  # the article proper and all nodes around it
    top, v = 0, best
    while v:
        if page.tag[v] == "main":
            top = v
        v = page.outer[v]
        around.add(v)
    other = [False] * n  # holders with an article at the article's own path
    for v in own:
        if page.path[v] == page.path[best]:
            holder = page.outer[v]
            other[page.outer[holder] if page.tag[holder] == "li" else holder] = True
    kept, dropped = [False] * n, [False] * n
    end = page.last[best]
    for v in range(1, n):
        dropped[v] = dropped[page.outer[v]]
        if page.tag[v] in HOLDERS and v not in around:
            if best < v <= end:
                dropped[v] |= page.n_articles[v] > 1
            elif v > end:
                dropped[v] |= page.n_articles[v] > 0 and not other[v] or page.tag[v] in ("ul", "ol") and page.n_items[v] > 1
        taken = v == top if top else page.tag[v] == "article" and page.path[v] == page.path[best]
        kept[v] = not dropped[v] and (kept[page.outer[v]] or taken)
    return kept


def _parsed(html: str, ignored: frozenset[int] = frozenset(), short_nav: bool = False) -> _Lines:
    parser = _Lines(ignored, short_nav)
    parser.feed(html)
    parser.close()
    return parser


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = _parsed(html)
    short_nav = parser.lost
    if short_nav:
        parser = _parsed(html, short_nav=True)
    wrong = parser.wrong_marks()
    if wrong:
        parser = _parsed(html, wrong, short_nav)
    lines = parser.lines
    if not lines:
        return ""
    ratios = smooth([len(text) / tags for text, tags, _, _ in lines])
    cut = threshold(ratios)
    held, content, by_node = defaultdict(int), defaultdict(int), defaultdict(int)
    of_articles = {parser.region[v] for v in range(1, len(parser.tag)) if parser.tag[v] in ("article", "main")}
    for (text, _, region, node), ratio in zip(lines, ratios):
        held[region] += len(text)
        if ratio >= cut:
            content[region] += len(text)
            by_node[node] += len(text)
    articles = sum(content[r] for r in of_articles & content.keys())
    if articles and articles >= MAJORITY * sum(content.values()):
        kept = _article_nodes(parser, by_node)
        return " ".join(text for text, _, _, node in lines if kept[node])
    chosen = {r for r in held if content[r] >= MAJORITY * held[r]}
    chosen.add(max(held, key=lambda r: (content[r], held[r], -r)))  # the region with most content
    beside = {r for r in held if parser.linked[r] > MAJORITY * held[r]} | of_articles
    chosen = _block(chosen - beside or chosen, parser.parents, beside)
    return " ".join(text for text, _, region, _ in lines if region in chosen)


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h) for h in batch.column(2).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["page_id", "url", "text"])

    kind = dict(pages.dtypes)["page_id"]
    found = pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
