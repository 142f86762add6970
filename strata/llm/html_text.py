"""Main text of web pages by the ratio of text to tags.

Parser events of the standard library stream over a page and build lines: a block element
starts a line, so a line is what a reader sees as one. Each line has its characters of text,
its tags and its links. The text-to-tag ratio of the lines is smoothed by a Gaussian, so a
short line inside an article takes part in its neighbourhood, and lines above a threshold
are content. Content lines near each other form a cluster, and the clusters select the
regions: an element that the page marks as an article is one region and is kept whole if
it holds a content line; elsewhere a region reaches from the first to the last line of its
cluster, and clusters of one container are one region with what stands between them, such
as a table or code. Every region with content is kept, however small. Beside marked
regions unmarked ones are kept too, unless all their content together has less than
``unmarked_share`` of the text of the marked ones. Lines that are mostly links are menus
and are left out of unmarked regions.

Menus, headers and footers of the page, sidebars, notices, adverts, forms, scripts, styles
and reader comments are left out by what they are marked as, before ratios are taken. A
mark is a whole word of a class or a whole id (``share-buttons``, not ``category-social``);
articles, main elements and headings are never left out by such words, and sections inside
an article only where their class says adverts or reader comments. What is named after a
comment (``comment-body``) is one, whatever else its name says. A form that has most of
the text of a page, in more lines than it has fields, is what the page is built in and no
form to be filled in. In a container that holds content its short lines are content too,
up to its end.

Defined results: NULL, empty and text-free pages give an empty text; unclosed elements end
with their container; plain text without tags is one block; repeated rows are extracted
each by itself; stray closing tags are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend "
    "li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul "
    "head".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements whose whole content is no main text.
DROPPED = frozenset(
    "script style noscript template head title nav footer aside button select option "
    "textarea input label fieldset iframe object svg canvas audio video menu dialog math "
    "map datalist".split()
)


def _words(words: str) -> re.Pattern:
    """Any of the words, standing by itself in a class, id or role."""
    return re.compile(rf"(?:^|[\s_-])(?:{words})(?:$|[\s_-])", re.IGNORECASE)


#: Words that only tell the form or the place of what a class names: ``share-buttons``.
_AROUND = re.compile(
    r"js|site|page|post|article|entry|blog|top|bottom|left|right|inline|sticky|floating|"
    r"main|icons?|links?|list|buttons?|btn|bar|box|area|blocks?|sections?|wrapper|wrap|"
    r"container|inner|outer|form|header|footer|title|slot|unit|banner|notice|widget|"
    r"items?|posts|articles|stories|story|thread|panel|tools|menu|rail|module|to|\d+",
    re.IGNORECASE,
)
_COMMENTS = r"comments?|commentlist|disqus|replies|reply|respond|responses"
_ADVERTS = r"ads?|advert[a-z]*|adsense|sponsor[a-z]*|promo[a-z]*"
#: Words that mark what is no main text, whatever stands beside them.
_NOISE = re.compile(
    rf"{_ADVERTS}|{_COMMENTS}|cookies?|consent|gdpr|popup|modal|"
    r"overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|"
    r"recommend[a-z]*|pagination|"
    r"pager|breadcrumbs?|complementary|contentinfo|navigation|navbar|paywall|copyright|"
    r"disclaimer|skip",
    re.IGNORECASE,
)
#: Of these the ones that no part of an article is named after by its topic.
_FOREIGN = re.compile(rf"{_ADVERTS}|{_COMMENTS}", re.IGNORECASE)
#: Words that mark parts of a page, or the layout of its content: ``content has-sidebar``.
_PARTS = (
    r"sidebar|side-bar|aside|nav|menu|header|footer|masthead|banner|notice|notices|alert|"
    r"toolbar|widget|widgets|search|breaking|tags|hidden"
)
_LAYOUT = _words(_PARTS)
_PART = re.compile(rf"(?:{_PARTS})", re.IGNORECASE)
_CONTENT = _words(r"article|content|main|post|entry|story|body|text")
_COMMENT = re.compile(r"comments?|commentlist|disqus", re.IGNORECASE)
#: Last words of classes that say whether a post can be commented on.
_STATES = frozenset("open closed enabled disabled allowed on off".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_JOINTS = re.compile(r"[_-]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: An open paragraph ends where one of these starts.
_ENDS_P = BLOCKS
_SELF_CLOSING = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
#: Elements that bound the search for what a start tag closes by itself.
_SCOPES = frozenset("ul ol dl table select body html article main section div".split())
#: Elements whose lines belong together.
_CONTAINERS = frozenset("div section center td article main".split())
_FIELDS = frozenset("input select textarea button".split())
_WHITE = re.compile(r"\s+")


def _says(name: str, words: re.Pattern) -> bool:
    """Whether a name holds one of the words and else only what they come in."""
    parts = [x for x in _JOINTS.split(name) if x]
    told = [bool(words.fullmatch(x)) for x in parts]
    return any(told) and all(t or _AROUND.fullmatch(x) for t, x in zip(told, parts))


def _is_comment(name: str) -> bool:
    """Whether a name starts as one of a comment does: ``comment-body``, ``comments_2``."""
    parts = [x for x in _JOINTS.split(name.lower()) if x]
    return bool(parts and _COMMENT.fullmatch(parts[0]) and parts[-1] not in _STATES)


@dataclass(frozen=True)
class Extraction:
    sigma: float = 1.5
    radius: int = 4
    threshold: float = 0.35
    max_link_share: float = 0.6
    max_gap: int = 3
    unmarked_share: float = 0.2
    form_share: float = 0.5


@dataclass
class Line:
    """A line of a page: its text and what stood around it."""

    parts: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0
    article: int = 0
    container: int = 0
    form: int = 0
    text: str = ""


class _Lines(HTMLParser):
    """Turns events into lines; ``lines`` holds those with text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool]] = []
        self.dropped = 0
        self.articles = 0
        self.article = 0
        self.links = 0
        #: Number of the open form (forms do not nest), and the fields of each form.
        self.form = 0
        self.fields = [0]
        self.lines: list[Line] = []
        self.line = Line()
        #: First line of each container, the one after its last, and the container that
        #: its lines belong to, which for a cell is the one around the table; 0 is the page.
        self.reach: list[list[int]] = [[0, -1, 0]]
        self.inside = [0]

    def break_line(self) -> None:
        text = _WHITE.sub(" ", "".join(self.line.parts)).strip()
        if text:
            self.line.text = text
            self.line.parts = []
            self.lines.append(self.line)
            self.line = Line()
        else:
            # Tags before the first text of a line are part of it.
            self.line = Line(tags=self.line.tags)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._close_implied(tag)
        if tag in BLOCKS:
            self.break_line()
        self.line.tags += 1
        if tag in _FIELDS and ("type", "hidden") not in attrs:
            self.fields[self.form] += 1
        if tag in VOID:
            if tag in ("br", "wbr") and not self.dropped:
                self.line.parts.append(" " if tag == "br" else "")
            return
        drop = self._is_noise(tag, attrs)
        article = tag in ("article", "main") and not self.dropped and not drop
        self.dropped += drop
        # The outermost marked element numbers the region.
        self.article += article and not self.articles
        self.articles += article
        self.links += tag == "a"
        if tag == "form" and not self.form:
            self.form = len(self.fields)
            self.fields.append(0)
        self.open.append((tag, drop, article))
        if tag in _CONTAINERS:
            number = len(self.reach)
            whole = self.reach[self.inside[-1]][2] if tag == "td" else number
            self.inside.append(number)
            self.reach.append([len(self.lines), -1, whole])

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        # A slash at the end closes nothing in HTML unless the element is void.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.break_line()
        self.line.tags += 1
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._pop_to(i)
                return
            if tag not in BLOCKS and self.open[i][0] in _SCOPES:
                return

    def handle_data(self, data: str) -> None:
        if self.dropped:
            return
        self.line.parts.append(data)
        if not self.line.container and data.strip():
            self.line.container = self.inside[-1]
        if self.form and not self.line.form and data.strip():
            self.line.form = self.form
        if self.articles and not self.line.article:
            self.line.article = self.article
        if self.links:
            self.line.linked += len(data.strip())

    def finish(self) -> list[Line]:
        self.close()
        self.break_line()
        for container in self.inside:
            self.reach[container][1] = len(self.lines)
        return self.lines

    def drop_forms(self, share: float) -> list[Line]:
        """Take the lines of forms out, but of one that is the container of the page."""
        size, rows = [0] * len(self.fields), [0] * len(self.fields)
        for line in self.lines:
            size[line.form] += len(line.text)
            rows[line.form] += 1
        kept = {0}
        for form in range(1, len(size)):
            if size[form] >= share * sum(size) and rows[form] > self.fields[form]:
                kept.add(form)
        before = [0]
        for line in self.lines:
            before.append(before[-1] + (line.form in kept))
        self.lines = [x for x in self.lines if x.form in kept]
        self.reach = [[before[a], before[b], c] for a, b, c in self.reach]
        return self.lines

    def _close_implied(self, tag: str) -> None:
        if tag in _ENDS_P:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == "p":
                    self._pop_to(i)
                    break
                if self.open[i][0] in _SCOPES or self.open[i][0] in ("td", "th", "li"):
                    break
        ends = _SELF_CLOSING.get(tag)
        if ends:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in ends:
                    self.break_line()
                    self._pop_to(i)
                    break
                if self.open[i][0] in _SCOPES:
                    break

    def _pop_to(self, i: int) -> None:
        for tag, drop, article in self.open[i:]:
            self.dropped -= drop
            self.articles -= article
            self.links -= tag == "a"
            if tag == "form" and not any(x[0] == "form" for x in self.open[:i]):
                self.form = 0
            if tag in _CONTAINERS:
                self.reach[self.inside.pop()][1] = len(self.lines)
        del self.open[i:]

    def _is_noise(self, tag: str, attrs: list) -> bool:
        if tag in DROPPED:
            return True
        if tag == "header":
            # The header of an article holds its title; that of the page a menu.
            return not self.articles
        if tag in ("html", "body"):
            return False
        marks = {}
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "style" and value and "display:none" in value.replace(" ", ""):
                return True
            if name in ("class", "id", "role") and value:
                marks[name] = _HUMP.sub("-", value)
        return bool(marks) and self._is_marked(tag, marks)

    def _is_marked(self, tag: str, marks: dict[str, str]) -> bool:
        """Whether the names of an element say that it is no main text.

        Only whole words of a class count, as classes also list the topics of a post, and
        ids of headings and sections are made of their titles.
        """
        if tag == "main" or tag in _HEADINGS:
            return False
        names = [w for x in ("class", "role") for w in marks.get(x, "").split()]
        if any(_is_comment(w) for w in names):
            return True
        if tag == "article":
            return False
        section = tag == "section" or "section" in names
        if section and self.articles:
            return any(_says(w, _FOREIGN) for w in names)
        names += [marks["id"]] if "id" in marks else []
        if any(_says(w, _NOISE) or _is_comment(w) for w in names):
            return True
        if self.articles:
            return any(_PART.fullmatch(w) for w in names) and not any(
                _CONTENT.search(x) for x in marks.values()
            )
        if section:
            marks = {x: v for x, v in marks.items() if x != "id"}
        return any(
            _LAYOUT.search(x) and not _CONTENT.search(x) for x in marks.values()
        )


def text_tag_ratios(lines: list[Line]) -> np.ndarray:
    """Characters of text outside links, for each tag of a line."""
    return np.array(
        [(len(x.text) - min(x.linked, len(x.text))) / max(x.tags, 1) for x in lines]
    )


def smooth(ratios: np.ndarray, how: Extraction) -> np.ndarray:
    """Gaussian average; at the ends the weights inside the page are scaled up."""
    offsets = np.arange(-how.radius, how.radius + 1)
    kernel = np.exp(-(offsets**2) / (2 * how.sigma**2))
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")
    total = np.convolve(ratios, kernel, "full")
    middle = slice(how.radius, how.radius + len(ratios))
    return total[middle] / weight[middle]


def main_text(html: str | None, how: Extraction = Extraction()) -> str:
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.finish()
    lines = parser.drop_forms(how.form_share)
    if not lines:
        return ""
    smoothed = smooth(text_tag_ratios(lines), how)
    # Relative to the page, so that a page of even lines is all content.
    content = smoothed >= how.threshold * float(smoothed.mean())
    marked = _marked_regions(lines, content)
    found = _clusters(lines, content, parser.reach, how)
    if marked:
        sizes = [
            sum(len(lines[i].text) for i in part if content[i]) for part in (found, marked)
        ]
        if sizes[0] < how.unmarked_share * sizes[1]:
            found = []
    return "\n".join(lines[i].text for i in sorted({*marked, *found}))


def _marked_regions(lines: list[Line], content: np.ndarray) -> list[int]:
    """Lines of the marked elements that hold content."""
    regions = {x.article for x, is_content in zip(lines, content) if is_content} - {0}
    return [i for i, x in enumerate(lines) if x.article in regions]


def _clusters(
    lines: list[Line], content: np.ndarray, reach: list[list[int]], how: Extraction
) -> list[int]:
    """Lines of the clusters outside marked elements."""
    menu = np.array([x.linked > how.max_link_share * len(x.text) for x in lines])
    own = np.array([not x.article for x in lines])
    at = np.flatnonzero(content & ~menu & own)
    if not len(at):
        return []
    # Whether the lines from a line of the page itself on are all its own.
    nested = np.cumsum([x.container > 0 for x in lines])

    def together(a: int, b: int) -> bool:
        if b - a <= how.max_gap:
            return True
        if not lines[a].container and not lines[b].container:
            return bool(nested[a] == nested[b])
        above, below = (reach[lines[i].container][2] for i in (a, b))
        return (above > 0 and reach[above][1] > b) or (below > 0 and reach[below][0] <= a)

    kept = np.zeros(len(lines), dtype=bool)
    kept[at] = True
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if together(a, b):
            kept[a:b] = True
    # Short lines beside content in its container, or in its stretch of the page itself.
    places = [(x.container, 0 if x.container else int(n)) for x, n in zip(lines, nested)]
    full = {places[i] for i in at.tolist()}
    kept |= np.array([x in full for x in places])
    return np.flatnonzero(kept & ~menu & own).tolist()


def extract(
    pages: DataFrame,
    id: str = "page_id",
    html: str = "html",
    carry: str = "url",
    how: Extraction = Extraction(),
) -> DataFrame:
    """One row per input row: page_id, url and the main text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), how) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    chosen = pages.select(
        F.col(id).cast("long").alias("page_id"),
        F.col(carry).cast("string").alias("url"),
        F.col(html).alias("html"),
    )
    return chosen.mapInArrow(run, "page_id long, url string, text string")
