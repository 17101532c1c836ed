"""Main text of web pages.

The standard library's streaming parser turns a page into events; the events become *lines*, one per
block element (a paragraph, heading, list item, cell, ...), each with its text and its number of tags.  Lines inside
navigation, headers, footers, side columns, forms, scripts, styles, and inside boxes whose class, id or role says
advert, notice, menu or comments are never content.  (Headings are no boxes; inside an article an id is a place that links
lead to, named by its subject, so only classes count there, and of boxes that aren't sections.)  Over the other lines the text-to-tag ratio is smoothed by a Gaussian
and split by a threshold into clusters.  A region (the lines directly under one container; all lines of an article) is content
if any of its lines is in the high cluster, so short paragraphs of an article stay with it.  On a page with an article
element, lines outside of it are no candidates, and the clusters decide once more inside: a block of an article (the lines directly
under one of its sections or divs) is dropped if all its lines have little text outside of links for their inline tags.

Defined cases: null or empty html gives an empty text; unclosed and stray tags follow the parser's events;
a page cut off in the middle gives what came before; very long pages are read in full; extra columns are kept.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from sourcelens.llm.common import map_rows

# fixed values: HTML's element names by role
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td "
                   "tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("nav header footer aside form menu dialog script style noscript template iframe object svg math canvas "
                 "select option button textarea input label audio video head".split())
SKIP_IN_ARTICLE = SKIP - {"header"}  # an article's own header holds its heading
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMES = re.compile(r"(?:^|\s)(?:(?:site|page|main|top|bottom|left|right|post|article|user|global|primary|secondary)[_-])?"
                   r"(?:ad|ads|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|cookie|cookies|consent|gdpr|"
                   r"notice|popup|modal|newsletter|subscribe|signup|sidebar|aside|widget|related|recommended|menu|nav|navbar|"
                   r"navigation|breadcrumb|breadcrumbs|footer|masthead|share|sharing|social|comment|comments|reply|replies|"
                   r"disqus|discussion|toolbar|pagination|pager|hidden)(?=$|[\s_-])", re.I)
CONTAINERS = frozenset("article main section div body td".split())
#: Containers that are blocks of their own inside an article; a cell belongs to its table's block.
INNER = frozenset("article main section div".split())
#: Tags that shape text; inside an article they don't count against it.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 hgroup li ul ol dl dt dd table thead tbody tfoot tr td th caption br pre blockquote figcaption".split())
#: Elements whose class or id can make them boilerplate.
BOXES = frozenset("a aside center dd details div dl dt fieldset figure li ol p section span table tbody td th tr ul".split())
#: Sources whose end tags may be left out: a new one ends the open one, through what is open inside it, but not beyond a barrier.
CLOSES = {"li": {"li"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
          "tbody": {"thead", "tbody"}, "tfoot": {"thead", "tbody"}}
BARRIERS = {"li": {"ul", "ol", "menu", "table", "td"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "dt": {"dl", "table", "td"},
            "dd": {"dl", "table", "td"}, "option": {"select", "datalist"}, "tbody": {"table"}, "tfoot": {"table"}}
#: These end an open paragraph.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hgroup hr li dt dd main menu nav ol p pre section table ul".split())
P_BARRIERS = frozenset("table caption td th button object template".split())
#: Any other element ends an open head.
IN_HEAD = frozenset("head title meta link base basefont bgsound script style noscript template".split())
#: Whose end tags go through open cells.
AROUND_CELLS = frozenset("tr tbody thead tfoot table".split())
SPACE = re.compile(r"\s+")
SIGMA = 1.0
#: A line is in the high cluster from this part of the standard deviation of the smoothed ratios on, as the method's authors do.
THRESHOLD = 1.0
#: Inside an article ratios count up to ENOUGH, so one long paragraph makes no other block look thin, and the threshold is smaller.
ENOUGH = 40.0
IN_ARTICLE = 0.25


class _Lines(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, tuple, float]] = []  # text, tags, region, characters outside of links for each inline tag
        self.open: list[tuple[str, bool, bool]] = []  # name, skipped, a link
        self.parts: list[str] = []
        self.tags = 0
        self.inline = 0
        self.links = 0
        self.linked = 0
        self.skipped = 0
        self.articles = 0
        self.number = 0
        self.kinds: dict[str, int] = {}  # how many of each name are open
        self.where: list[tuple[int, int]] = [(0, 0)]  # region: its number, that of the outermost article or 0

    def line(self):
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.lines.append((text, self.tags, self.where[-1], max(0, len(text) - self.linked) / max(1, self.inline)))
            self.tags = self.inline = 0
        self.parts = []
        self.linked = 0

    def count(self, tag):
        self.tags += 1
        self.inline += tag not in TEXTUAL
        if tag in BLOCKS:
            self.line()

    def handle_starttag(self, tag, attrs):
        self.end_head(tag)
        self.count(tag)
        if tag in ENDS_P:
            self.close_open({"p"}, P_BARRIERS)
        if tag in VOID:
            return
        if tag in CLOSES:
            self.close_open(CLOSES[tag], BARRIERS[tag])
        said = dict(attrs)
        names = said.get("class") or ""
        if not self.articles:
            names += " " + (said.get("id") or "")
        skip = (tag in (SKIP_IN_ARTICLE if self.articles else SKIP) or (said.get("role") or "").lower() in ROLES
                or "hidden" in said or (said.get("aria-hidden") or "") == "true"
                or tag in BOXES and not (self.articles and tag == "section") and bool(NAMES.search(names)))
        self.number += 1
        link = tag == "a" and "href" in said
        self.open.append((tag, skip, link))
        self.skipped += skip
        if tag in CONTAINERS:
            article = self.where[-1][1] or (self.number if tag == "article" else 0)
            self.where.append(self.where[-1] if self.articles and tag not in INNER else (self.number, article))
        self.articles += tag == "article"
        self.links += link
        self.kinds[tag] = self.kinds.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.end_head(tag)
        self.count(tag)

    def end_head(self, tag):
        if self.kinds.get("head") and tag not in IN_HEAD and (self.open[-1][0] == "head" or tag == "body"):
            self.close_open({"head"}, ())

    def close_open(self, ends, barriers):
        """Ends the innermost of ``ends`` with all that is open inside it, unless a barrier is nearer."""
        if not any(self.kinds.get(tag) for tag in ends):
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] in ends:
                return self.close_from(at)
            if self.open[at][0] in barriers:
                return

    def close_from(self, at):
        for tag, skip, link in reversed(self.open[at:]):
            if tag in BLOCKS:
                self.line()
            self.skipped -= skip
            self.kinds[tag] -= 1
            self.articles -= tag == "article"
            self.links -= link
            if tag in CONTAINERS and len(self.where) > 1:
                self.where.pop()
        del self.open[at:]

    def handle_endtag(self, tag):
        self.count(tag)
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self.close_from(at)
                break
            if self.open[at][0] in CONTAINERS and tag not in CONTAINERS and tag not in SKIP and not (
                    self.open[at][0] == "td" and tag in AROUND_CELLS):
                break  # a stray end tag doesn't close what holds it

    def handle_data(self, data):
        if self.open and self.open[-1][0] == "head" and not data.isspace():
            self.end_head("")
        if not self.skipped:
            self.parts.append(data)
            if self.links:
                self.linked += len(SPACE.sub(" ", data))

    def unknown_decl(self, data):
        pass


def lines_of(html: str | None) -> list[tuple[str, int, tuple, float]]:
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    parser.line()
    return parser.lines


def _smoothed(x: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, int(3 * sigma + 0.5))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(x, kernel, "full")[reach:-reach]
    return total / np.convolve(np.ones(len(x)), kernel, "full")[reach:-reach]


def _blocks_of_articles(lines: list[tuple[str, int, tuple, float]], sigma: float, threshold: float) -> list[tuple[str, int, tuple, float]]:
    """The lines without those of blocks that hold little but links.  Each block is smoothed alone, so it isn't lifted by its neighbours."""
    own: dict[tuple, list[float]] = {}
    for _, _, where, ratio in lines:
        own.setdefault(where, []).append(min(ratio, ENOUGH))
    smooth = {where: _smoothed(np.array(x), sigma) for where, x in own.items()}
    every = np.concatenate(list(smooth.values()))
    least = min(IN_ARTICLE * threshold * every.std(), every.max())
    return [x for x in lines if smooth[x[2]].max() >= least]


def content_lines(lines: list[tuple[str, int, tuple, float]], sigma: float = SIGMA, threshold: float = THRESHOLD) -> list[str]:
    articles = any(where[1] for _, _, where, _ in lines)
    if articles:
        lines = [x for x in lines if x[2][1]]
    if not lines:
        return []
    smooth = _smoothed(np.array([len(text) / max(1, tags) for text, tags, _, _ in lines]), sigma)
    high = smooth >= min(threshold * smooth.std(), smooth.max())
    region = [where[1] or where for _, _, where, _ in lines]  # all lines of an article are one
    regions = {r for r, h in zip(region, high, strict=True) if h}
    lines = [x for x, r in zip(lines, region, strict=True) if r in regions]
    return [x[0] for x in (_blocks_of_articles(lines, sigma, threshold) if articles else lines)]


def main_text(html: str | None) -> str:
    return "\n".join(content_lines(lines_of(html)))


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without the html column, plus ``text`` and ``n_chars``."""
    kept = pages.drop("text", "n_chars")
    fields = [f for f in kept.schema.fields if f.name != html]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "`text` string", "`n_chars` bigint"])

    def run(columns):
        texts = [main_text(h) for h in columns.pop(html)]
        return {**columns, "text": texts, "n_chars": [len(t) for t in texts]}

    return map_rows(kept, run, schema)
