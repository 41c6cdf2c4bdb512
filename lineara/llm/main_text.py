"""Operator 5: the main text of web pages by text-to-tag ratios.

The standard library's parser reads a page as a stream of events, from which lines are built: a line is the text
between two borders of block elements, with the tags seen since the line before. Tags and roles take out what is never
main text: menus, page headers, footers, sidebars, forms, scripts, styles, embedded objects. Names (class, id) that say
advert, notice, menu, sidebar or reader comments only make an element a suspect, whose lines are read like others:

* outside an article or main a suspect goes, whatever its length, unless it is the wrapper of the page: it has the first
  heading, and nothing outside the suspects has one or is an article. If no line would be left, the names are those of
  wrappers and all stay;
* in an article or main a suspect stays if it is built like a part of the text (a section, or something with a heading)
  and its ratios are those of content for at least half of its letters; a name that only adverts have always goes;
* lists of reader comments go; an article or main stands out from what wraps it, but not from comments.

Each line has a text-to-tag ratio (letters outside links for each tag). The ratios are smoothed with a Gaussian along
the page and parted into two clusters by a threshold midway between their means; lines above it are content (all, if one mean isn't twice the other), if their
container also has a line that is above it by itself (smoothing fills gaps, but doesn't reach into the next box). Containers
(article, main, section, div, table cell, body) are then rated: letters of content in them less a quarter of their other
letters. The best one is the region, the deepest where several are as good. An article or main around it or in it that
holds most of the content is never parted, and where the region has no heading the next container around it that has
one, and nearly the same rating, is taken instead. All lines of the region are the main text, short ones too, with two
exceptions where no article or main says what belongs together: stretches below the threshold that are mostly
links are menus; and where neither a container nor a tag nor a name parts the page, the text begins with the first line
of content, or headings right before it, and ends with the last.

Character references are decoded, white space in a line becomes one space, lines are joined by a newline. Of regions
that rate alike the deepest and last one counts. A null or empty page, or one without text, gives an empty text; a null
page_id or url stays null; equal rows are separate pages; an empty table gives no rows. All columns but page_id, url and
html are ignored. Time and memory are in proportion to a page's length and number of tags, however deep they are nested;
a page is read whole.
"""

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema

FED = 1 << 16
SIGMA = 1.5
MOST = 0.6
OTHER = 0.25
AS_GOOD = 0.9
APART = 2
#: Of a suspect's letters in an article, those that have to be content for it to stay.
READS = 0.5
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template head title nav footer aside form button select textarea iframe object svg dialog menu audio video canvas map datalist fieldset".split())
#: Those without text that a reader sees.
SILENT = frozenset("script style noscript template head title".split())
CONTAINERS = frozenset("article main section div td th body".split())
BLOCKS = CONTAINERS | frozenset("address blockquote caption dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr html legend li ol p pre summary table tbody tfoot thead tr ul".split()) | SKIPPED
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar".split())
#: Whole words of names: adverts, notices, sidebars, menus, footers.
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adslot|sponsor(?:ed|s)?|promo\w*|cookies?|consent|gdpr|notices?|popup|modal|newsletter|sidebars?|nav|navbar|navigation|menus?|breadcrumbs?|footer)(?:$|[\s_-])", re.I
)
TOP = re.compile(r"(?:^|[\s_-])(?:header|masthead|topbar|banner)(?:$|[\s_-])", re.I)
#: Names that only adverts have.
ADVERT = re.compile(r"(?:^|[\s_-])(?:ads?|advert|advertisements?|advertising|adsense|adslot|sponsored)(?:$|[\s_-])", re.I)
#: Whole names of lists of reader comments.
COMMENTS = re.compile(r"(?:^|\s)(?:(?:reader-?|user-?|post-)?comments?(?:-?(?:list|area|section|thread|body|wrapper))?|disqus(?:_thread|-thread)?|replies|respond)(?:$|\s)", re.I)


class Suspect:
    """An element whose name says that it isn't main text."""

    __slots__ = ("up", "inside", "section", "advert", "comments", "first_heading", "heading")

    def __init__(self, up: int, inside: bool, section: bool, advert: bool, comments: bool):
        self.up, self.inside, self.section, self.advert, self.comments = up, inside, section, advert, comments
        self.first_heading = self.heading = False


class Lines(HTMLParser):
    """Collects lines: (text, tags, letters in links, container, whether a heading, suspect); marked parts of the page are left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list = []  # (tag, marked, silent, article, container, suspect before) of the elements that matter
        self.at: dict = {}  # for each tag the places in open
        self.marked = self.silent = self.links = 0
        self.within = 0  # open articles and mains
        self.parents, self.articles = [-1], [False]
        self.container = self.suspect = 0
        self.suspects: list = [Suspect(-1, False, False, False, False)]  # 0 stands for none
        self.lines: list = []
        self.parts: list = []
        self.tags = self.linked = 0
        self.heading = False
        self.left_out = 0  # letters in marked parts

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, self.linked, self.container, self.heading, self.suspect))
            self.tags = 0
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
            self.heading = tag in ("h1", "h2")
            if tag in HEADINGS and not self.marked:
                self.suspects[self.suspect].heading = True
                self.suspects[self.suspect].first_heading |= tag == "h1"
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag == "a":
            self.links += 1
        if tag == "body" and self.marked:  # a head that was never closed
            self._close(0)
        inside, said, suspect = self.within > 0, dict(attrs) if attrs else {}, self.suspect
        noise = int(tag in SKIPPED or tag == "header" and not inside)
        if tag in ("article", "main"):
            noise = 0 if self.silent else -self.marked  # an article stands out from what wraps it
            suspect = suspect if self.suspects[suspect].comments else 0
        elif said and not noise and tag not in ("html", "body", "a"):
            noise = int(said.get("role") in ROLES or "hidden" in said or said.get("aria-hidden") == "true")
            name = f"{said.get('class') or ''} {said.get('id') or ''}"
            comments = bool(COMMENTS.search(name)) and tag != "p"
            if not noise and (comments or not (inside and tag in ("h1", "h2", "h3", "p", "header")) and (NOISE.search(name) or not inside and TOP.search(name))):
                suspect = len(self.suspects)
                self.suspects.append(Suspect(self.suspect, inside, tag == "section", bool(ADVERT.search(name)), comments or self.suspects[self.suspect].comments))
        if noise or suspect != self.suspect or tag in CONTAINERS or self.marked and tag in BLOCKS:
            self.at.setdefault(tag, []).append(len(self.open))
            change = (noise, int(tag in SILENT), int(tag in ("article", "main")))
            self.open.append((tag, change, self.container, self.suspect))
            self._count(change, 1)
            if suspect != self.suspect:
                self.end_line()
            self.suspect = suspect
            if tag in CONTAINERS:
                self.parents.append(self.container)
                self.articles.append(tag in ("article", "main"))
                self.container = len(self.parents) - 1

    def _count(self, change: tuple, by: int) -> None:
        noise, silent, within = change
        self.marked += by * noise
        self.silent += by * silent
        self.within += by * within

    def _close(self, k: int) -> None:
        """Close the open elements from the k-th on."""
        while len(self.open) > k:
            tag, change, container, suspect = self.open.pop()
            if suspect != self.suspect:
                self.end_line()
            self.container, self.suspect = container, suspect
            self.at[tag].pop()
            self._count(change, -1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
            self.heading = False
        if tag == "a":
            self.links = max(0, self.links - 1)
        if self.at.get(tag):
            self._close(self.at[tag][-1])

    def handle_data(self, data):
        if not self.marked:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)
        elif not self.silent:
            self.left_out += len(data.strip())

    def drop(self, gone) -> None:
        """Leave out the lines of the suspects for which gone() holds, and of those in them; all stay if none would."""
        out = [False] * len(self.suspects)
        for k, suspect in enumerate(self.suspects[1:], 1):  # outer ones come first
            out[k] = gone(k, suspect) or suspect.up > 0 and out[suspect.up]
        left = [line for line in self.lines if not out[line[5]]]
        if left:
            self.left_out += sum(len(line[0]) for line in self.lines if out[line[5]])
            self.lines = left


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Ratios under a Gaussian along the page."""
    half = int(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-half, half + 1) / SIGMA) ** 2)
    whole = np.convolve(ratios, kernel)[half : half + len(ratios)]
    return whole / np.convolve(np.ones(len(ratios)), kernel)[half : half + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """The value midway between the means of the clusters that it parts; the least value where the means aren't apart by APART."""
    at = float(values.mean())
    for _ in range(50):
        low, high = values[values < at], values[values >= at]
        if not len(low) or not len(high):
            return float(values.min())
        new = (float(low.mean()) + float(high.mean())) / 2
        if abs(new - at) < 1e-9:
            break
        at = new
    return at if float(high.mean()) >= APART * float(low.mean()) else float(values.min())


def contents(page: Lines, ratios: np.ndarray) -> np.ndarray:
    """Which lines are content: smoothed ratios above the threshold, in a container that has such a line before smoothing too."""
    even = smoothed(ratios)
    at = threshold(even)
    container = np.array([line[3] for line in page.lines])
    own = np.bincount(container, ratios >= at, len(page.parents)) > 0
    return (even >= at) & own[container]


def read(html: str) -> Lines:
    """The lines of a page without those of suspects that its structure gives away."""
    page = Lines()
    for k in range(0, len(html), FED):
        page.feed(html[k : k + FED])
    page.close()
    page.end_line()
    headed = any(page.articles) or page.suspects[0].first_heading
    for s in reversed(page.suspects):
        if s.up > 0:  # what a suspect holds, those around it hold too
            page.suspects[s.up].first_heading |= s.first_heading
            page.suspects[s.up].heading |= s.heading
    page.drop(lambda k, s: s.comments or (s.advert if s.inside else headed or not s.first_heading))
    return page


def ratios(page: Lines) -> np.ndarray:
    """Letters outside links for each tag."""
    return letters(page) / np.maximum(1, [line[1] for line in page.lines])


def letters(page: Lines) -> np.ndarray:
    return np.array([len(line[0]) - min(len(line[0]), line[2]) for line in page.lines], dtype=float)


def judge_parts(page: Lines) -> None:
    """Leave out the suspects in articles that aren't built or don't read like the text."""
    if not any(line[5] for line in page.lines):
        return
    of, length = [line[5] for line in page.lines], np.array([len(line[0]) for line in page.lines], dtype=float)
    whole, good = (np.bincount(of, values, len(page.suspects)) for values in (length, np.where(contents(page, ratios(page)), length, 0)))
    for k in range(len(page.suspects) - 1, 0, -1):
        whole[max(0, page.suspects[k].up)] += whole[k]
        good[max(0, page.suspects[k].up)] += good[k]
    page.drop(lambda k, s: s.inside and not ((s.section or s.heading) and good[k] >= READS * whole[k]))


def sums(page: Lines, values: np.ndarray) -> np.ndarray:
    """For each container the sum over all lines in it."""
    out = np.bincount([line[3] for line in page.lines], values, len(page.parents))
    for c in range(len(page.parents) - 1, 0, -1):  # parents come before children
        out[page.parents[c]] += out[c]
    return out


def around(page: Lines, c: int):
    """The containers around one, from the next on."""
    while (c := page.parents[c]) >= 0:
        yield c


def region(page: Lines, content: np.ndarray, letters: np.ndarray) -> int:
    """The container of the main text."""
    length = np.array([len(line[0]) for line in page.lines], dtype=float)
    held = sums(page, np.where(content, letters, 0))
    rating = held - OTHER * sums(page, np.where(content, 0, length))
    best = len(rating) - 1 - int(np.argmax(rating[::-1] >= rating.max() - 1e-9))  # a child comes after its parents
    most = MOST * held[0]
    up = [c for c in around(page, best)]
    whole = [c for c in up if page.articles[c] and held[c] > most]
    if whole:
        return whole[0]
    if not page.articles[best]:
        inner = [c for c in range(len(held)) if page.articles[c] and held[c] > most and best in around(page, c)]
        if inner:
            return inner[0]
        headings = sums(page, np.array([float(line[4]) for line in page.lines]))
        if not headings[best]:
            near = [c for c in up[:-1] if headings[c] and rating[c] >= AS_GOOD * rating[best]]
            best = near[0] if near else best
    return best


def stretches(yes: np.ndarray):
    """(start, end) of the runs of true values."""
    edge = np.diff(np.concatenate([[0], yes.astype(np.int8), [0]]))
    return zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = read(html)
    if not page.lines:
        return ""
    judge_parts(page)
    own = letters(page)
    content = contents(page, ratios(page))
    root = region(page, content, own)
    inside = np.zeros(len(page.parents), dtype=bool)
    inside[root] = True
    for c in range(root + 1, len(inside)):
        inside[c] = inside[page.parents[c]]
    kept = inside[[line[3] for line in page.lines]]
    if not any(page.articles[c] for c in (root, *around(page, root))):
        if kept.all() and not page.left_out and content.any():
            first, last = np.flatnonzero(content)[[0, -1]]
            while first > 0 and page.lines[first - 1][4]:
                first -= 1
            kept[:first] = kept[last + 1 :] = False
        for s, e in stretches(kept & ~content):
            if sum(line[2] for line in page.lines[s:e]) > sum(len(line[0]) for line in page.lines[s:e]) / 2:
                kept[s:e] = False
    return "\n".join(line[0] for line, yes in zip(page.lines, kept) if yes)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    ddl = "page_id long, url string, text string, n_chars long"
    schema = arrow_schema(ddl)

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                got = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(got, pa.string()), pa.array(list(map(len, got)), pa.int64())], schema=schema)

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, ddl)
