"""Main text of HTML pages: streaming parser events, text-to-tag ratios, Gaussian smoothing, clusters over a threshold.

The standard library's parser is fed a page piece by piece. Its events become lines, one per block element, each with its
text, its number of tags, the characters inside links, the container it stands in, and whether it stands in something that
names itself boilerplate (navigation, footer, form, advertisement, comments and the like). The ratio of text outside
links to tags of the lines is smoothed with a Gaussian kernel; runs of lines whose smoothed ratio passes a share of the
ratios' spread are the content clusters, and these choose the content regions. Where the page has article or main elements,
the regions are those with a cluster (or, with no cluster, the one with most text), and all their lines that do not stand
in boilerplate are the text, short ones too, but for runs of ``LINK_RUN`` lines or more that are mostly links and whose
smoothed ratio is below the limit: menus inside an article. Elsewhere the region is the innermost container that has ``REGION_SHARE`` of the
clusters' text and every line whose own ratio, not only the smoothed one, passes; its lines count if their own container has a
cluster, if they stand between clusters and are not mostly links, or if they are headings before its last cluster. A title that
stands before the region in a container around it counts too, with the lines up to the region that are not mostly links.

A class, id or role names boilerplate if a whole token of it does: all its parts are listed or say nothing, or the first is
listed and has no other use in titles. A token with a listed word among others (``notice-period``) and, inside an article, a
token that is one of the words with other uses (``notice``, ``share``, ``banner``) only shift the limit: such a block is
boilerplate where most of it is links or its smoothed ratio is below ``NAMED`` times the limit. Ids of headings and sections are made
from titles and hide nothing, names of headings inside an article and of a block that holds an article's first heading neither.

Tags and comments that are never closed are text, found by one look for the last closing sign, so broken pages cost no more than
others. White space inside a block becomes one space, character references are decoded, blocks are joined by two line feeds. A null
or empty page gives an empty text; unclosed and stray tags are tolerated; repeated rows give repeated results; an
empty table gives an empty result. Columns other than id, address and html are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.text import quoted, slices

SIGMA, RADIUS = 1.0, 2
#: Share of the standard deviation of the smoothed ratios that a content line passes.
SPREAD = 0.5
#: Share of the clusters' text that the content region of a page without article and main elements holds at least.
REGION_SHARE = 0.8
#: Times the limit that the smoothed ratio of a block passes whose name makes it a suspect.
NAMED = 1.25
#: Lines of links one after the other that may be a menu.
LINK_RUN = 3
FEED_CHARS = 1 << 16

# HTML's elements by role.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = set("article main section div td body blockquote figure".split())
LANDMARKS = {"article", "main"}
HEADINGS = {f"h{rank}" for rank in range(1, 7)}
HIDDEN = set(
    "script style noscript template head title nav footer aside form button select option textarea iframe object svg canvas "
    "dialog audio video map datalist".split()
)
ENDS_PARAGRAPH = BLOCKS - {"html", "body"}
# Words of class, id and role attributes that name boilerplate.
BOILERPLATE = set(
    "ad ads adv advert adverts advertisement advertising adbox adsbygoogle banner breadcrumb breadcrumbs comment comments "
    "commentlist cookie cookies consent disclaimer disqus footer footnav form header masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices notification pager pagination popup promo promotion related recommended replies reply "
    "search share sharing shares sidebar sidebars signup skip social sponsor sponsored subscribe subscription toolbar topbar widget "
    "contentinfo complementary alert".split()
)
# Listed words that titles use as well; a token that begins with one names boilerplate only as a whole.
AMBIGUOUS = set(
    "alert banner comment comments consent disclaimer form header menu notice notices notification navigation promotion "
    "recommended related replies reply search share sharing shares skip social".split()
)
# Parts of tokens that say nothing about the role of an element.
NEUTRAL = set(
    "area article articles bar block body bottom box btn button buttons col column container content count entry feed fixed float "
    "footer group head heading icon icons inline inner item items left link links list main media mobile module news outer page pane "
    "panel post posts primary region right row secondary section site slot space sticky story stories text title top unit video "
    "videos view wrap wrapper".split()
)
# Listed words that inside an article only make a block a suspect.
SOFT = set("alert banner disclaimer form notice notices promotion recommended search share sharing shares skip social".split())
# Words of attributes that describe a layout rather than name its part.
LAYOUT = set("has with without no layout".split())
# Words that name boilerplate outside an article only.
PAGE_PARTS = {"header", "masthead"}
WORDS = re.compile(r"[a-z]+")
SPACES = re.compile(r"\s+")


def names_boilerplate(tag: str, attributes: list[tuple[str, str | None]], in_article: bool) -> bool | None:
    """Whether an element is boilerplate by its names; None where its text decides."""
    if tag in HIDDEN or tag == "header" and not in_article:
        return True
    verdict: bool | None = False
    for key, value in attributes:
        if key in ("class", "id", "role") and value and tag not in ("body", "html"):
            if in_article and tag in HEADINGS:
                continue
            if key == "id" and (tag == "section" or tag in HEADINGS) or not LAYOUT.isdisjoint(WORDS.findall(value.lower())):
                continue
            for token in value.lower().split():
                words = WORDS.findall(token)
                named = BOILERPLATE.intersection(words) - (PAGE_PARTS if in_article else set())
                if not named:
                    continue
                if in_article and len(words) == 1 and words[0] in SOFT:
                    verdict = None
                    continue
                if words[0] in named - AMBIGUOUS or all(w in BOILERPLATE or w in NEUTRAL or len(w) < 3 for w in words):
                    return True
                verdict = None
        elif key == "hidden" or key == "aria-hidden" and value == "true":
            return True
    return verdict


@dataclass
class Suspect:
    """A block whose text decides whether it is boilerplate."""

    above: int
    in_article: bool
    titled: bool = False  # holds the first heading of an article


@dataclass
class Line:
    text: str
    tags: int
    linked: int
    hidden: bool
    container: int
    landmark: int
    heading: int = 0  # rank, 0: none
    suspect: int = 0

    @property
    def links(self) -> bool:
        return 2 * self.linked >= len(self.text)


@dataclass
class Open:
    tag: str
    hidden: bool
    container: int
    landmark: int
    heading: int = 0
    suspect: int = 0


@dataclass
class Lines(HTMLParser):
    """Turns parser events into lines; only the current line's pieces and the open elements are held besides them."""

    lines: list[Line] = field(default_factory=list)

    def __post_init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[Open] = [Open("", False, 0, 0)]
        self.count: dict[str, int] = {}
        self.pieces: list[str] = []
        self.tags = self.linked = 0
        self.parents = [0]  # of each container
        self.suspects = [Suspect(0, True)]  # the first stands for none
        self.titled: set[int] = set()  # landmarks that have had a heading

    def end_line(self) -> None:
        text = SPACES.sub(" ", "".join(self.pieces)).strip()
        top = self.open[-1]
        if text:
            self.lines.append(Line(text, self.tags, self.linked, top.hidden, top.container, top.landmark, top.heading, top.suspect))
            self.tags = self.linked = 0
        elif self.pieces:
            self.linked = 0
        self.pieces = []

    def close_to(self, tag: str) -> None:
        while len(self.open) > 1:
            closed = self.open[-1].tag
            if closed in BLOCKS or self.open[-1].hidden != self.open[-2].hidden:
                self.end_line()
            self.open.pop()
            self.count[closed] -= 1
            if closed == tag:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in VOID:
            if tag == "hr":
                self.end_line()
            elif tag == "br":
                self.pieces.append(" ")
            return
        if tag in ENDS_PARAGRAPH and self.count.get("p"):
            self.close_paragraph()
        if tag in ("li", "td", "th", "tr", "dt", "dd", "option") and self.open[-1].tag == tag:
            self.close_to(tag)
        top = self.open[-1]
        named = names_boilerplate(tag, attrs, bool(top.landmark))
        hidden, suspect = top.hidden or named is True, top.suspect
        if named is None and not hidden and tag in BLOCKS:
            self.suspects.append(Suspect(suspect, bool(top.landmark)))
            suspect = len(self.suspects) - 1
        if tag in BLOCKS or hidden != top.hidden:
            self.end_line()
        container, landmark = top.container, top.landmark
        if tag in CONTAINERS and not hidden:
            self.parents.append(container)
            container = len(self.parents) - 1
            landmark = landmark or (container if tag in LANDMARKS else 0)
        heading = int(tag[1]) if tag in HEADINGS else top.heading
        if heading and landmark and not hidden and landmark not in self.titled:
            self.titled.add(landmark)
            self.suspects[suspect].titled = True
        self.open.append(Open(tag, hidden, container, landmark, heading, suspect))
        self.count[tag] = self.count.get(tag, 0) + 1

    def close_paragraph(self) -> None:
        """A block ends an open paragraph, unless a container stands between them."""
        for o in reversed(self.open):
            if o.tag == "p":
                self.close_to("p")
                return
            if o.tag in BLOCKS:
                return

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "br":
            self.pieces.append(" ")
        elif self.count.get(tag):
            self.close_to(tag)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_data(self, data: str) -> None:
        self.pieces.append(data)
        if self.count.get("a"):
            self.linked += len(data.strip())


def mended(html: str) -> str:
    """The page with what opens a tag or comment that is never closed as plain text."""
    end = html.rfind("-->") + 3 if "-->" in html else 0
    html = html[:end] + html[end:].replace("<!--", " ")
    end = html.rfind(">") + 1
    return html[:end] + html[end:].replace("<", "&lt;")


def parsed(html: str) -> Lines:
    """The lines of a page, with the parent of each container and the suspects."""
    parser, html = Lines(), mended(html)
    for start in range(0, len(html), FEED_CHARS):
        parser.feed(html[start : start + FEED_CHARS])
    parser.close()
    parser.end_line()
    return parser


def smoothed(ratios: np.ndarray, sigma: float = SIGMA, radius: int = RADIUS) -> np.ndarray:
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, radius, mode="edge"), kernel / kernel.sum(), mode="valid")


def title_lines(lines: list[Line], parents: list[int], region: int, within: np.ndarray, first: int) -> set[int]:
    """The titles before line ``first`` that stand in containers around the region, and what follows them up to there.

    From the region outwards, a container adds the heading nearest to the region that outranks all headings so far, and beyond
    the first such title none that is mostly a link. A heading of a list of links is no title.
    """
    found: set[int] = set()
    if not region:
        return found
    around = {c := region}
    while c:
        around.add(c := parents[c])
    lists = {x.container for x in lines if not x.hidden and not x.heading and x.links} - around

    def level(container: int) -> int:
        while container not in around:
            container = parents[container]
        return container

    best = min((x.heading for i, x in enumerate(lines[: first + 1]) if x.heading and not x.hidden and within[x.container]), default=7)
    titles = [(i, level(x.container)) for i, x in enumerate(lines[:first]) if x.heading and not x.hidden and not within[x.container] and x.container not in lists]
    c, named = region, False
    while c:
        c = parents[c]
        for i, at in reversed(titles):
            if at == c and lines[i].heading < best and not (named and lines[i].links):
                best, named = lines[i].heading, True
                found.add(i)
                found |= {k for k in range(i, first) if not lines[k].hidden and not lines[k].links and level(lines[k].container) >= c}
    return found


def line_ratios(lines: list[Line]) -> tuple[np.ndarray, np.ndarray, float]:
    """Characters outside links of each line (0 if hidden), smoothed ratios to tags, and the limit content passes."""
    own = np.array([0 if x.hidden else max(len(x.text) - x.linked, 0) for x in lines], float)
    ratios = smoothed(own / np.maximum([x.tags for x in lines], 1))
    return own, ratios, SPREAD * ratios.std()


def without_suspects(lines: list[Line], suspects: list[Suspect], ratios: np.ndarray, limit: float) -> None:
    """Hide the lines of suspects that are no text. Where an article stands outside them, no suspect of the page around counts."""
    n = len(suspects)
    outer = [False] * n
    for k in range(1, n):
        outer[k] = outer[suspects[k].above] or not suspects[k].in_article
    chars, linked, ratio, count = [0] * n, [0] * n, [0.0] * n, [0] * n
    for x, r in zip(lines, ratios, strict=True):
        if not x.hidden:
            chars[x.suspect] += len(x.text)
            linked[x.suspect] += x.linked
            ratio[x.suspect] += r
            count[x.suspect] += 1
    for k in range(n - 1, 0, -1):  # a suspect comes after the one around it
        for total in (chars, linked, ratio, count):
            total[suspects[k].above] += total[k]
        suspects[suspects[k].above].titled |= suspects[k].titled
    article = any(x.landmark and not x.hidden and not outer[x.suspect] for x in lines)
    gone = [False] * n
    for k in range(1, n):
        thin = ratio[k] < NAMED * limit * count[k] or 2 * linked[k] >= chars[k]
        gone[k] = gone[suspects[k].above] or outer[k] and article or thin and not suspects[k].titled
    for x in lines:
        x.hidden = x.hidden or gone[x.suspect]


def menu_lines(lines: list[Line], ratios: np.ndarray, limit: float) -> set[int]:
    """Lines of long runs of links whose smoothed ratio is below the limit."""
    found: set[int] = set()
    run: list[int] = []
    for i, x in enumerate([*lines, None]):
        if x is not None and x.hidden:
            continue
        if x is not None and x.links and not x.heading:
            run.append(i)
            continue
        if len(run) >= LINK_RUN and ratios[run].mean() < limit:
            found.update(run)
        run = []
    return found


def main_lines(page: Lines) -> list[Line]:
    """The lines of the content regions."""
    lines, parents = page.lines, page.parents
    if not lines:
        return []
    if len(page.suspects) > 1:
        without_suspects(lines, page.suspects, *line_ratios(lines)[1:])
    own, ratios, limit = line_ratios(lines)
    cluster = (ratios >= limit) & (own > 0)
    weight: dict[int, float] = {}
    for x, chars, inside in zip(lines, own, cluster, strict=True):
        if x.landmark and not x.hidden:
            weight[x.landmark] = weight.get(x.landmark, 0) + chars * inside + 1e-6 * chars
    if any(weight.values()):
        most = max(weight.values())
        regions = {k for k, w in weight.items() if w >= 1 or w == most}
        menus = menu_lines(lines, ratios, limit)
        return [x for i, x in enumerate(lines) if not x.hidden and x.landmark in regions and i not in menus]
    at = np.flatnonzero(cluster)
    if not len(at):
        return []
    mass = np.zeros(len(parents))
    for i in at:
        mass[lines[i].container] += own[i]
    for c in range(len(parents) - 1, 0, -1):  # a container comes after its parent
        mass[parents[c]] += mass[c]
    strong = [i for i in at if own[i] / max(lines[i].tags, 1) >= limit]
    count = np.zeros(len(parents), int)
    for i in strong:
        count[lines[i].container] += 1
    for c in range(len(parents) - 1, 0, -1):
        count[parents[c]] += count[c]
    region = max(c for c in range(len(parents)) if mass[c] >= REGION_SHARE * mass[0] and count[c] == len(strong))
    within = np.zeros(len(parents), bool)
    for c in range(len(parents)):
        within[c] = c == region or c > 0 and within[parents[c]]
    clustered = {lines[i].container for i in at}
    inside = [i for i in at if within[lines[i].container]]
    titles = title_lines(lines, parents, region, within, inside[0])
    return [
        x
        for i, x in enumerate(lines)
        if i in titles or not x.hidden and within[x.container]
        and (x.container in clustered or at[0] < i < at[-1] and not x.links or x.heading and i < inside[-1])
    ]


def main_text(html: str) -> str:
    return "\n\n".join(x.text for x in main_lines(parsed(html)))


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    columns = pages.select(quoted(page_id).alias("page_id"), quoted(url).alias("url"), quoted(html).alias("html"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "html"):
            found = [main_text(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = dict(columns.dtypes)
    return columns.mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
