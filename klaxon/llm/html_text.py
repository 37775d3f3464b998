"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page's events into lines, one per block of text.
A line's ratio is its letters per tag; lines in menus, adverts and the like have the ratio
0. Ratios are smoothed by a Gaussian, and lines above a threshold, the spread of the page's
ratios, make up the content region: the articles around them if these hold most of their
text, or else the smallest element around all of them. All of its lines count, short
headings too, but for those that say themselves that they are something else. A class or id
says nothing where it follows a word like "with" or holds nearly all of the page's text, and
none does where they leave no line.
"""

import re
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klaxon.llm.batches import to_batch

TEXTS = "page_id bigint, url string, text string, n_chars bigint"
RADIUS, WIDTH = 3, 1.0
# Letters per tag that links in a list do not have.
PLAIN = 10
# Share of the selected text that articles hold where they are the content.
MOST = 0.8
# Share of a page's text from which an element is what holds the page, whatever it is called.
NEARLY_ALL = 0.95

# Names from the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr img nobr center".split()
)
HIDDEN = set(
    "head title script style noscript template iframe object svg math canvas audio video "
    "button select textarea option datalist dialog".split()
)
# What a head may hold; everything else ends it, as its end tag may be left out.
IN_HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
# Of these, what hides to its end tag only, and all else that follows if it has none not.
ENDED = set("object svg math canvas audio video button select option datalist dialog".split())
ASIDE = set("nav aside footer menu fieldset".split())
ROLES = set(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu "
    "menubar toolbar status note".split()
)
# Whole words of a class or id, between anything that is no letter.
WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup "
    "popup modal overlay paywall sidebar aside related recommended widget widgets share sharing "
    "social breadcrumb breadcrumbs menu nav navbar navigation pagination pager toc footer masthead "
    "skip login search comment comments commentlist respond reply replies disqus discussion "
    "feedback outbrain taboola form".split()
)
# Those of readers' comments.
COMMENTS = set(
    "comment comments commentlist respond reply replies disqus discussion feedback".split()
)
# A line from which a form around all is a page's frame.
LONG_LINE = 80
# An element named "with-sidebar" or "hasMenu" is around such a thing.
AROUND = set("with without has have no and".split())
# Elements that hold the content whatever the elements around them are called.
CONTENT = {"article", "main"}


HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# What an element says of itself.
NOTHING, SAID, FORM, NAMED, TALK = range(5)


def _says_other(tag, attributes, in_content):
    """Whether an element says of itself that it is no content."""
    if tag in ASIDE or tag == "header" and not in_content:
        return True
    for name, value in attributes:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value and value.lower() in ROLES:
            return True
    return False


def _sounds_other(tag, attributes):
    """NAMED or TALK if an element's class or id sounds like no content, else NOTHING."""
    found = NOTHING
    for name, value in attributes:
        if name in ("class", "id") and value and tag not in ("body", "html", *CONTENT):
            for names in value.split():
                names = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", names)
                before = ""
                for word in re.split(r"[^a-z]+", names.lower()):
                    if word in COMMENTS and before not in AROUND:
                        return TALK
                    if word in WORDS and before not in AROUND:
                        found = NAMED
                    before = word
    return found


class _Element(NamedTuple):
    """An element that may hold lines. ``clears``: it holds content whatever is around it."""

    parent: int
    tag: str
    mark: int
    clears: bool


class _Lines(HTMLParser):
    """Lines of a page, (text, tags, element, hider), and its elements, by number.

    A line's element is the innermost one around it, ``hider`` the outermost one that hides
    it, or 0. An element stands after the ones around it.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.parts, self.tags = [], [], 0
        self.elements = [_Element(-1, "", NOTHING, False)]
        self.ended = set()
        # Open elements: (tag, number, hider, in content).
        self.open = [("", 0, 0, False)]
        self.counts = {}

    def flush(self):
        text = " ".join("".join(self.parts).split())
        _, element, hider, _ = self.open[-1]
        if text:
            self.lines.append((text, self.tags, element, hider))
            if not hider:
                self.tags = 0
        self.parts = []

    def _end_head(self):
        if self.counts.get("head"):
            self._pop_to([one[0] for one in self.open].index("head"))

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "head" and any(one[0] not in ("", "html") for one in self.open):
            return
        if tag == "body" and not self.counts.get("template"):
            self._end_head()
        elif self.open[-1][0] == "head" and tag not in IN_HEAD:
            self._end_head()
        if tag == "br":
            self.parts.append("\n")
        if tag in VOID:
            if tag == "hr":
                self.flush()
            return
        if tag not in INLINE:
            self.flush()
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                self._end_open(tag)
        _, element, hider, inside = self.open[-1]
        if tag == "body" and not self.counts.get("template"):
            hider = 0
        inside = inside or tag in CONTENT
        mark = _sounds_other(tag, attrs)
        if _says_other(tag, attrs, inside):
            mark = SAID
        elif tag == "form" and mark != TALK:
            mark = FORM
        if tag not in INLINE or mark:
            # An element left open before the content cannot claim it.
            clears = tag in CONTENT and not any(self.counts.get(one) for one in ASIDE)
            self.elements.append(_Element(element, tag, mark, clears))
            element = len(self.elements) - 1
        if tag in HIDDEN and not hider:
            hider = element
        self.open.append((tag, element, hider, inside))
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div", "article", "main", "section"):
            self.handle_endtag(tag)

    def _end_open(self, tag):
        """End a paragraph or the like that a new one follows without an end tag."""
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                self._pop_to(at)
                return
            if self.open[at][0] not in INLINE and self.open[at][0] != "p":
                return

    def _pop_to(self, at):
        for name, *_ in self.open[at:]:
            self.counts[name] -= 1
        del self.open[at:]

    def handle_endtag(self, tag):
        self.tags += 1
        if not self.counts.get(tag):
            return
        if tag not in INLINE:
            self.flush()
        at = len(self.open) - 1
        while self.open[at][0] != tag:
            # An inline element does not end the block around it.
            if tag in INLINE and self.open[at][0] not in INLINE:
                return
            at -= 1
        self.ended.add(self.open[at][1])
        self._pop_to(at)

    def handle_data(self, data):
        if self.open[-1][0] == "head" and data.strip():
            self._end_head()
        self.parts.append(data)

    def seen(self):
        """Lines (text, tags, element) that nothing hides."""
        return [
            (text, max(tags, 1), element)
            for text, tags, element, hider in self.lines
            if not hider
            or self.elements[hider].tag in ENDED and hider not in self.ended
        ]


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian mean of each ratio and its neighbours."""
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / WIDTH) ** 2)
    weights = np.convolve(np.ones(len(ratios)), kernel)[RADIUS : RADIUS + len(ratios)]
    return np.convolve(ratios, kernel)[RADIUS : RADIUS + len(ratios)] / weights


def clusters(ratios: np.ndarray, headings: np.ndarray) -> np.ndarray:
    """Lines of the clusters in which the smoothed ratio is above the threshold, its spread.

    Smoothing lifts the neighbours of long lines, so a cluster is cut back to lines that are
    above the threshold themselves or have ``PLAIN`` letters a tag, and to headings; short
    ones between them stay, and so do headings directly before.
    """
    smooth = smoothed(ratios)
    threshold = min(smooth.std(), smooth.max())
    high = smooth >= threshold
    firm = high & (ratios >= min(threshold, PLAIN)) & ~headings
    if not firm.any():
        return high
    edges = np.flatnonzero(np.diff(np.concatenate([[False], high, [False]]).astype(np.int8)))
    chosen = np.zeros(len(ratios), bool)
    for start, end in zip(edges[::2], edges[1::2]):
        if firm[start:end].any():
            kept = start + np.flatnonzero((firm | headings)[start:end])
            first = kept[0]
            while first and headings[first - 1]:
                first -= 1
            chosen[first : kept[-1] + 1] = True
    return chosen


def _other(elements, lines):
    """Whether each element is no content, and so the lines in it.

    What an element says holds for all in it up to the next content. What its name says does so
    if it holds less than nearly all letters, that of comments even for content in it.
    """
    said = _spread(elements, {at for at, one in enumerate(elements) if one.mark == SAID})
    letters, longest = np.zeros(len(elements)), np.zeros(len(elements))
    for text, _, element in lines:
        if not said[element]:
            letters[element] += len(text)
            longest[element] = max(longest[element], len(text))
    most = NEARLY_ALL * letters.sum()
    # Letters in each element, and those not in content within it.
    whole, outside = letters.copy(), letters.copy()
    for at in range(len(elements) - 1, 0, -1):
        one = elements[at]
        whole[one.parent] += whole[at]
        longest[one.parent] = max(longest[one.parent], longest[at])
        if not one.clears:
            outside[one.parent] += outside[at]
    marks = np.array([one.mark for one in elements])
    forms = (marks == FORM) & ((outside < most) | (longest < LONG_LINE))
    named = (marks == NAMED) & (outside < most)
    talk = (marks == TALK) & (whole < most)
    for names in (True, False):
        marked = (marks == SAID) | forms | (named if names else False)
        other = _spread(elements, set(np.flatnonzero(marked)))
        if names:
            below = _spread(elements, set(np.flatnonzero(talk)), through=True)
            other = [one or two for one, two in zip(other, below)]
        # Names that leave no line say nothing.
        if not names or not all(other[element] for _, _, element in lines):
            return other


def _spread(elements, marked, through=False):
    """Which elements are marked or below a marked one, content between them cleared unless
    ``through``."""
    found = []
    for at, one in enumerate(elements):
        below = at > 0 and found[one.parent] and (through or not one.clears)
        found.append(below or at in marked)
    return found


def _inside(elements, mass):
    """Which elements are in the content, from the selected letters directly in each element.

    If articles and the like hold most of them, all of these with selected letters are;
    otherwise the smallest element around all selected letters is.
    """
    # The article around an element, or else the outermost main; 0 is neither.
    content = [0] * len(mass)
    for element in range(1, len(mass)):
        around = content[elements[element].parent]
        tag = elements[element].tag
        if tag == "article" or tag in CONTENT and not around:
            around = element
        content[element] = around
    content = np.array(content)
    inside = np.zeros(len(mass), bool)
    if mass[content > 0].sum() >= MOST * mass.sum():
        inside[content[(content > 0) & (mass > 0)]] = True
    else:
        inner = mass.copy()
        for element in range(len(inner) - 1, 0, -1):
            inner[elements[element].parent] += inner[element]
        # Children have larger numbers than their parents: the last one with all is innermost.
        inside[int(np.flatnonzero(inner >= inner[0])[-1])] = True
    for element in range(1, len(inside)):
        inside[element] |= inside[elements[element].parent]
    return inside


def main_text(html: str | None) -> str:
    """Text of a page's main content: blocks in page order, joined by one space.

    Character references are decoded, white space inside a block becomes one space. A page
    without content gives an empty text. Nothing of the content is dropped or cut.
    """
    parser = _Lines()
    html = html or ""
    # A comment that is never closed reaches to the end.
    open_comment = html.rfind("<!--") > html.rfind("-->")
    parser.feed(html + "-->" if open_comment else html)
    parser.close()
    parser.flush()
    elements, lines = parser.elements, parser.seen()
    other = _other(elements, lines)
    ratios = np.array([0 if other[element] else len(text) / tags for text, tags, element in lines])
    if not ratios.any():
        return ""
    headings = [elements[element].tag in HEADINGS for _, _, element in lines]
    chosen = clusters(ratios, np.array(headings)) & (ratios > 0)
    mass = np.zeros(len(elements))
    for (text, _, element), taken in zip(lines, chosen):
        if taken:
            mass[element] += len(text)
    if not mass.any():
        for text, _, element in lines:
            mass[element] += 0 if other[element] else len(text)
    inside = _inside(elements, mass)
    return " ".join(text for text, _, element in lines if inside[element] and not other[element])


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``.

    A null html counts as empty. Other columns play no part; repeated rows come back as
    often as they occur.
    """

    def extract(batches):
        for batch in batches:
            rows = []
            for page, url, html in zip(*[column.to_pylist() for column in batch.columns]):
                text = main_text(html)
                rows.append((page, url, text, len(text)))
            yield to_batch(rows, TEXTS)

    chosen = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return chosen.mapInArrow(extract, TEXTS)
