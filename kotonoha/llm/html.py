"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's parser streams start tags, end tags and text. Events
become lines: one per block of text, with its characters, the tags in it, and
the section (article, main, div, cell, body) it stands in. Parts that are never
article text by their element or a whole name of theirs (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, comments of readers) are left out
while streaming; a main part is a region like others, inside an article a block
with such a name goes only where its text agrees. The ratio of characters to tags per line is smoothed with a
Gaussian over neighbouring lines, and lines above a threshold form the content
cluster. Where articles and mains hold nearly all characters of the cluster, the
outermost ones with any of it are the content region, otherwise the lowest
section that holds every line of the cluster. All lines of the region are the
result, short ones too.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kotonoha.llm.common import scored_texts

# Element names by their part in a page.
SKIPPED = frozenset(
    "head script style noscript template nav aside footer form button select option textarea iframe object svg "
    "canvas dialog menu datalist map audio video title annotation annotation-xml".split()
)
# Marks of a formula, which are no tags of the text around it; annotations repeat the formula.
FORMULA = frozenset(
    "math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot msup msub msubsup mover munder munderover mtable mtr "
    "mtd mstyle mpadded menclose mmultiscripts mprescripts".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
SECTIONS = frozenset("article main section div td body".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


def _compounds(first: str, second: str) -> frozenset:
    return frozenset(f"{a}-{b}" for a in first.split() for b in second.split())


# Whole names (class, id or role) that mark a part as no article text wherever it stands.
ADVERTS = frozenset("ad ads advert adverts advertisement advertising adsbygoogle".split()) | _compounds(
    "ad ads advert advertisement advertising", "banner block box container slot unit wrapper wrap label area"
)
COMPOUNDS = (
    _compounds("share sharing social", "bar button buttons icon icons tools widget")
    | _compounds("social", "links share sharing")
    | _compounds("related", "posts articles stories news")
    | _compounds("cookie cookies consent", "banner bar notice consent popup modal overlay message")
    | _compounds("newsletter", "signup form box subscribe subscription banner")
    | _compounds("comment comments", "list area section form respond thread threads wrapper")
    | _compounds("site main post page primary secondary top", "nav navbar navigation")
    | _compounds("site", "footer sidebar")
    | _compounds("nav breadcrumb breadcrumbs", "bar menu links list")
)
UNAMBIGUOUS = ADVERTS | COMPOUNDS | {"disqus-thread"}
# Classes and roles, but no anchors, of blocks in an article: id=comments may be its chapter on them.
UNAMBIGUOUS_CLASSES = UNAMBIGUOUS | frozenset(
    "breadcrumb breadcrumbs navbar comments commentlist disqus navigation contentinfo".split()
)
# These mark a block outside articles only; inside one they are everyday words.
UNWANTED = (
    UNAMBIGUOUS_CLASSES
    | frozenset(
        "banner comment consent cookie cookies footer header masthead menu modal nav newsletter notice notices popup promo "
        "related share sharing sidebar social sponsor sponsored subscribe toolbar widget search complementary alert "
        "alertdialog dialog".split()
    )
    | _compounds(
        "site page main top bottom global left right primary secondary mobile sub",
        "header footer nav navbar navigation menu sidebar banner masthead",
    )
    | _compounds(
        "header footer nav navbar navigation menu sidebar search widget promo",
        "container wrapper wrap inner bar area links left right top bottom menu nav block box widgets primary secondary form",
    )
    | _compounds("notice notices alert promo sponsor subscribe popup modal newsletter", "bar banner box popup modal overlay")
    | _compounds("related share social", "links content box container wrapper")
)
# Of these the names that mark a block beside the text in a main part, and in an
# article where its text agrees; the others are everyday words there.
SUSPECT = frozenset(
    name
    for name in UNWANTED
    if not set(name.split("-"))
    & set("header banner masthead alert alertdialog dialog search complementary widget widgets mobile".split())
)
COMMENTS = frozenset("comment comments".split())
# Elements that stand around other blocks; paragraphs, sections and headings are text whatever their names.
CONTAINERS = frozenset("div ul ol dl li table details fieldset center".split())
# An article of this kind is no article text either.
UNWANTED_ARTICLES = ADVERTS | frozenset("comment comments comment-body promo sponsored".split())
# Blocks whose id is an anchor, and blocks that are headings.
ANCHORED = frozenset("section dt".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup summary caption figcaption legend".split())
# A start tag of the first kind ends an open element of the second.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
# Up to these ancestors an open element may be closed by its likes.
SCOPE = frozenset("table ul ol dl select body html".split())

SIGMA = 1.0
SHARE = 0.9
# From this share of its characters in links a suspect block is a list of links.
LINKED = 0.5

_HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_DASHES = re.compile(r"[-_]+")


def _names(value: str) -> list[str]:
    """Whole names of an attribute; siteHeader and site_header are site-header."""
    return [one for v in value.split() for one in (v.lower(), _DASHES.sub("-", _HUMP.sub("-", v)).lower().strip("-"))]


def hidden(attributes: list[tuple]) -> bool:
    for name, value in attributes:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and value and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def unwanted(tag: str, attributes: list[tuple], place: str) -> bool:
    """Whether a name says that an element is no article text; ``place``: "article", "main" or "".

    Headings and inline elements are text of what they stand in, whatever their
    names; outside articles an inline element may be an advert by its class.
    """
    inline = tag not in BLOCKS or tag in HEADINGS
    if inline and place:
        return False
    for name, value in attributes:
        if name not in ("class", "id", "role") or not value:
            continue
        if tag == "article":
            words = UNWANTED_ARTICLES if name == "class" else frozenset()
        elif inline:
            words = ADVERTS if name == "class" else frozenset()
        elif name == "id":
            words = frozenset() if tag in ANCHORED else UNAMBIGUOUS if place else UNWANTED
        else:
            words = UNAMBIGUOUS_CLASSES if place else UNWANTED
        if words and not words.isdisjoint(_names(value)):
            return True
    return place == "main" and bool(suspicion(tag, attributes))


def suspicion(tag: str, attributes: list[tuple]) -> str:
    """The kind of block that a container's whole name suggests: "comment", "side" or none."""
    if tag not in CONTAINERS:
        return ""
    names = {n for name, value in attributes if name in ("class", "id", "role") and value for n in _names(value)}
    if names & COMMENTS:
        return "comment"
    return "side" if names & SUSPECT else ""


class _Lines(HTMLParser):
    """Blocks of text with their tag counts and sections."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple] = []  # name, section, skipped
        self.sections = [-1]  # parent of each section; 0 is the page
        self.main: set[int] = set()  # in an article or main
        self.articles: set[int] = set()  # in an article
        self.lines: list[tuple] = []  # text, tags, section
        self.links_only: list[bool] = []  # of each line
        # Suspect blocks in articles: kind and place among their likes; the outermost one of each line.
        self.suspects: list[tuple] = []
        self.suspect_of: list[int] = []
        self.suspect = -1
        self.linked: list[int] = []  # characters in links of each line
        self.linked_now = 0
        self.open: Counter = Counter()
        self.elements = 0
        self.parts: list[str] = []
        self.tags = 0
        self.in_link = False
        self.plain = False

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, self.stack[-1][1] if self.stack else 0))
            self.links_only.append(not self.plain)
            self.suspect_of.append(self.suspect)
            self.linked.append(self.linked_now)
        self.parts, self.tags, self.plain, self.linked_now = [], 0, False, 0

    def pop_to(self, at: int):
        while len(self.stack) > at:
            self.flush() if self.stack[-1][0] in BLOCKS else None
            name, *_, suspect, _ = self.stack.pop()
            self.open[name] -= 1
            self.suspect = suspect
            if name == "a":
                self.in_link = False

    def close(self):
        super().close()
        self.pop_to(0)
        self.flush()

    def _end_open(self, names: tuple, scope: frozenset):
        if not any(self.open[n] for n in names):
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] in names:
                self.pop_to(at)
                return
            if self.stack[at][0] in scope:
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
            # A paragraph ends where any block begins.
            self._end_open(("p",), BLOCKS - {"p"})
        if tag in CLOSES:
            self._end_open(CLOSES[tag], SCOPE)
        self.tags += tag not in FORMULA
        if tag == "br":
            self.parts.append(" ")
        if tag == "a":
            self.in_link = any(name == "href" for name, _ in attrs)
        if tag in VOID:
            return
        section, skipped = (self.stack[-1][1], self.stack[-1][2]) if self.stack else (0, False)
        inside = section in self.main
        place = "article" if section in self.articles else "main" if inside else ""
        if tag in SECTIONS and not skipped:
            self.sections.append(section)
            section = len(self.sections) - 1
            if inside or tag in ("article", "main") or ("role", "main") in attrs:
                self.main.add(section)
            if place == "article" or tag == "article":
                self.articles.add(section)
        skipped = skipped or tag in SKIPPED or tag == "header" and not inside
        if attrs and not skipped and tag not in ("html", "body", "main"):
            skipped = hidden(attrs) or unwanted(tag, attrs, place)
        before = self.suspect
        if before < 0 and place == "article" and not skipped and (kind := suspicion(tag, attrs)):
            # Likes are the suspects of one kind with the same parent element.
            self.suspects.append((kind, (kind, self.stack[-1][4] if self.stack else 0)))
            self.suspect = len(self.suspects) - 1
        self.elements += 1
        self.open[tag] += 1
        self.stack.append((tag, section, skipped, before, self.elements))

    def handle_endtag(self, tag):
        self.tags += tag not in FORMULA
        if not self.open[tag]:
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self.pop_to(at)
                return

    def handle_data(self, data):
        if not (self.stack and self.stack[-1][2]):
            self.parts.append(data)
            if self.in_link:
                self.linked_now += len("".join(data.split()))
            self.plain = self.plain or not self.in_link and any(map(str.isalnum, data))


def smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian mean over the neighbouring lines; at the ends over those there are."""
    reach = max(1, math.ceil(3 * sigma))
    weights = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        low, high = max(0, i - reach), min(len(values), i + reach + 1)
        some = weights[low - i + reach : high - i + reach]
        out.append(sum(w * v for w, v in zip(some, values[low:high], strict=True)) / sum(some))
    return out


def cluster_threshold(lines: list[tuple]) -> tuple[list[float], float]:
    """Smoothed ratios of text to tags and the half of their mean."""
    ratios = smoothed([len(text) / max(1, tags) for text, tags, _ in lines])
    return ratios, sum(ratios) / max(1, len(ratios)) / 2


def content_lines(lines: list[tuple]) -> list[bool]:
    """Lines of the content cluster: smoothed ratio above half of its mean."""
    ratios, threshold = cluster_threshold(lines)
    return [r >= threshold for r in ratios]


def dropped_suspects(parser: _Lines) -> set[int]:
    """The suspect blocks in articles whose text agrees with their name.

    Those are lists of links, blocks whose own ratio of text to tags is below the
    cluster's threshold, and comments that stand beside each other.
    """
    threshold = cluster_threshold(parser.lines)[1]
    characters, linked, tags = Counter(), Counter(), Counter()
    for (text, n, _), block, links in zip(parser.lines, parser.suspect_of, parser.linked, strict=True):
        characters[block] += len(text)
        linked[block] += links
        tags[block] += max(1, n)
    likes = Counter(group for kind, group in parser.suspects)
    return {
        block
        for block, (kind, group) in enumerate(parser.suspects)
        if linked[block] >= LINKED * characters[block]
        or characters[block] < threshold * tags[block]
        or kind == "comment" and likes[group] > 1
    }


def content_region(parser: _Lines, chosen: list[bool]) -> list[bool]:
    """Sections that are returned, from the lines of the content cluster."""
    parents = parser.sections
    # The outermost article or main around each section, or -1.
    outer = [-1] * len(parents)
    for section in range(1, len(parents)):
        outer[section] = outer[parents[section]]
        if outer[section] < 0 and section in parser.main:
            outer[section] = section
    cluster = [(len(text), s) for (text, _, s), one in zip(parser.lines, chosen, strict=True) if one]
    inside = sum(n for n, s in cluster if outer[s] >= 0)
    if inside and inside >= SHARE * sum(n for n, _ in cluster):
        regions = {outer[s] for _, s in cluster if outer[s] >= 0}
    else:
        # Lines of links alone, which smoothing takes in beside long lines, do not widen it.
        plain = {s for (_, _, s), one, links in zip(parser.lines, chosen, parser.links_only, strict=True) if one and not links}
        # Sections are numbered in order of the page, so the first and the last one span the others.
        low, high = min(plain or {s for _, s in cluster}), max(plain or {s for _, s in cluster})
        while low != high:
            low, high = (parents[low], high) if low > high else (low, parents[high])
        # An article or main around it is returned whole.
        regions = {outer[low] if outer[low] >= 0 else low}
    kept = [False] * len(parents)
    for section in range(len(parents)):
        kept[section] = section in regions or section > 0 and kept[parents[section]]
    return kept


def extract(html: str | None) -> str:
    """Main text of a page, a line per block; empty if there is none."""
    if not html:
        return ""
    parser = _Lines()
    try:
        parser.feed(html)
        parser.close()
    except AssertionError:  # an unknown marked section: read its mark as text
        parser = _Lines()
        parser.feed(html.replace("<![", "&lt;!["))
        parser.close()
    lines = parser.lines
    if not lines:
        return ""
    kept = content_region(parser, content_lines(lines))
    dropped = dropped_suspects(parser) if parser.suspects else ()
    return "\n".join(
        text
        for (text, _, section), block in zip(lines, parser.suspect_of, strict=True)
        if kept[section] and block not in dropped
    )


def extract_pages(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(id, url, text, n_chars) for every page, one pass, no shuffle.

    Missing and empty pages, and pages without article text, have the empty
    text. Ids and urls may be missing or repeated; other columns are not read.
    """

    def build():
        return lambda pages: {"text": [extract(h) for h in pages]}

    keyed = pages.select(F.struct(id_col, url_col).alias("_key"), F.col(html_col).alias("_html"))
    found = scored_texts(keyed, build, "text string", {"text": pa.string()}, id_col="_key", text_col="_html")
    return found.select(
        F.col(f"_key.{id_col}"), F.col(f"_key.{url_col}"), "text", F.length("text").cast("long").alias("n_chars")
    )
