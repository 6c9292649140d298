"""Main text of HTML pages by two passes over their blocks.

A page is read once into blocks: the text between block-level tags, with what the rules need of their surroundings. The
first pass decides every block that stop-word density, length and link density can decide; parts that announce themselves
as something else (navigation, forms, comments, ...) are bad whatever they say. The second pass gives the ambiguous ones,
short blocks above all, the label of the nearest decided neighbours: of the same container first, and of the same article
if the page marks one. Pages are independent rows, so nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules of the first pass: shares of stop words, characters of a short and of a long block, share of characters in links.
STOPS_LOW, STOPS_HIGH = 0.12, 0.25
SHORT, LONG = 70, 200
LINKS_MOST = 0.5

#: Frequent function words of English, French, German and Spanish, and their elided forms.
STOP_WORDS = frozenset(
    """
    a about after all also an and any are as at be been but by can could did do for from had has have he her his how i if in
    into is it its more my no not of on one or our out she so some than that the their them then there they this to up was
    we were what when which who will with would you your
    à au aux avec ce ces cette comme d dans de des du elle en est et ils il je l la le les leur lui mais même ne nous on ou
    où par pas plus pour qu que qui sa se ses si son sont sur un une vous y
    aber als am an auch auf aus bei bis das dass dem den der des die doch du ein eine einem einen einer er es für hat ich
    ihr im in ist man mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war was wenn werden wie
    wir wird zu zum zur
    al como con cuando del desde e el ella ellos en entre era esta este están fue ha hay la las lo los me mi muy más ni no
    nos o para pero por porque que se sin sobre su sus también te tiene todo un una y ya
    """.split()
)

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content isn't markup, and others without text of the page.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset("head template svg math object select datalist canvas audio video map applet".split())
APART = frozenset("nav footer aside form fieldset button menu dialog".split())
ROLES = frozenset("navigation contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Words in a class or id that tell what an element is for.
PURPOSES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promos promotion promoted "
    "nav navbar navigation navi menu menus breadcrumb breadcrumbs sidebar sidebars aside rail widget widgets footer colophon masthead "
    "topbar toolbar cookie cookies consent gdpr notice notices notification popup modal overlay alert comment comments "
    "commentlist disqus respond replies discussion share sharing social follow related recommended recommendations newsletter "
    "subscribe subscription signup login search pagination pager copyright disclaimer skip".split()
)
COMMENTS = frozenset("comment comments commentlist disqus respond replies discussion".split())
#: Words that turn a following one into a property of the layout: a page "with sidebar" is no sidebar.
LAYOUT = frozenset("no has with without is on off hide show".split())
CONTENT = frozenset("article articlebody content entry post story main maincontent".split())
CONTENT_PART = frozenset("article entry post story main page content body text".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Containers by which neighbours are told apart; lists, tables and quotations belong to the one around them.
CONTAINERS = frozenset("article aside body details dialog div fieldset footer form header html main nav section".split())
#: Elements within which an open paragraph isn't closed by a new block.
SCOPES = frozenset("button caption html object table td th template".split())

GOOD, NEAR, BRIEF, BAD = "good", "near good", "short", "bad"

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_REST = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*+>""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[^\W\d_]+")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Block:
    """Text of a page between two block-level tags. Levels of content: 0 none, 1 by name, 2 main, 3 article."""

    text: str
    link_chars: int
    apart: bool
    level: int
    container: int
    heading: bool
    label: str = ""


@dataclass
class Element:
    name: str
    apart: bool
    level: int
    link: bool
    hidden: bool
    container: int


@dataclass
class Reader:
    """Blocks of one page, from its tags and texts in order."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[Element] = field(default_factory=lambda: [Element("", False, 0, False, False, 0)])
    open: Counter = field(default_factory=Counter)
    text: list[str] = field(default_factory=list)
    links: list[str] = field(default_factory=list)
    containers: int = 0
    breaks: int = 0
    heading: bool = False
    content_seen: bool = False

    def flush(self) -> None:
        """End of a block."""
        if self.text:
            words = " ".join("".join(self.text).split())
            if words:
                top = self.stack[-1]
                linked = len(" ".join("".join(self.links).split()))
                self.blocks.append(Block(words, linked, top.apart, top.level, top.container, self.heading))
            self.text, self.links = [], []
        self.breaks = 0

    def data(self, raw: str) -> None:
        top = self.stack[-1]
        if top.hidden or not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        self.text.append(text)
        if top.link:
            self.links.append(text)
        if self.breaks and not text.isspace():
            self.breaks = 0

    def pop(self, to: int) -> None:
        for e in self.stack[to:]:
            self.open[e.name] -= 1
        del self.stack[to:]

    def close_paragraph(self) -> None:
        if self.open["p"] > 0:
            for i in range(len(self.stack) - 1, 0, -1):
                name = self.stack[i].name
                if name == "p":
                    return self.pop(i)
                if name in BLOCKS or name in SCOPES:
                    return None
        return None

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.breaks += 1
            self.flush() if self.breaks == 2 else self.text.append(" ")
            return
        block = name in BLOCKS
        if block:
            self.flush()
            self.close_paragraph()
        if name in VOID:
            return
        if name in ("li", "dt", "dd", "tr", "td", "th", "option") and self.stack[-1].name == name:
            self.pop(len(self.stack) - 1)  # its end tag may be left out
        self.stack.append(self.element(name, attributes))
        self.open[name] += 1
        if block:
            self.heading = name in HEADINGS

    def end(self, name: str) -> None:
        block = name in BLOCKS
        if block:
            self.flush()
            self.heading = False
        if self.open[name] <= 0:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].name == name:
                return self.pop(i)
            if not block and self.stack[i].name in BLOCKS:
                return None
        return None

    def element(self, name: str, attributes: str) -> Element:
        """What an element is, from its name, role, class and id, and from the elements around it."""
        around = self.stack[-1]
        found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
        hidden = around.hidden or name in HIDDEN or "hidden" in found or found.get("aria-hidden") == "true"
        hidden = hidden or "display:none" in found.get("style", "").replace(" ", "").lower()
        role = found.get("role", "").lower()
        purposes = self.purposes(found)
        level = around.level
        if name == "article" or found.get("itemprop") == "articleBody":
            level = 3
        elif name == "main" or role == "main":
            level = max(level, 2)
        elif name in ("div", "section", "td") and self.is_content(found):
            level = max(level, 1)
        apart = around.apart or name in APART or role in ROLES
        if name in ("header", "hgroup") or role == "banner" or "header" in purposes:
            apart = apart or around.level < 2  # an article's own header holds its title
        if purposes & PURPOSES and name not in ("html", "body", "main", "article"):
            apart = apart or level == around.level or bool(purposes & COMMENTS)
        if name == "article" and purposes & COMMENTS:
            apart = True
        elif level >= 2 and around.level < 2 and not self.content_seen:
            apart = False  # the first article of the page, whatever the name of what is around it
        self.content_seen = self.content_seen or level >= 2
        if name in CONTAINERS:
            self.containers += 1
        container = self.containers if name in CONTAINERS else around.container
        return Element(name, apart, level, around.link or name == "a", hidden, container)

    @staticmethod
    def purposes(found: dict[str, str]) -> set[str]:
        out = set()
        for value in (found.get("class", ""), found.get("id", "")):
            for token in value.split():
                parts = [p.lower() for p in _PART.findall(token)]
                out.update(p for i, p in enumerate(parts) if not (i and parts[i - 1] in LAYOUT))
        return out

    @staticmethod
    def is_content(found: dict[str, str]) -> bool:
        """Is a class or the id a name of content, such as ``content`` or ``post-body``?"""
        for token in f"{found.get('class', '')} {found.get('id', '')}".split():
            parts = [p.lower() for p in _PART.findall(token)]
            if parts and (len(parts) == 1 and parts[0] in CONTENT or len(parts) > 1 and all(p in CONTENT_PART for p in parts)):
                return True
        return False


def read_blocks(page: str) -> list[Block]:
    """Blocks of a page in order. Comments, declarations and raw elements are skipped; a tag without an end is text."""
    reader, at, n = Reader(), 0, len(page)
    last = page.rfind(">")  # no tag ends behind it, so none is looked for there
    while at < n:
        tag = page.find("<", at)
        if tag < 0 or tag > last and not page.startswith("<!--", tag):
            reader.data(page[at:])
            break
        reader.data(page[at:tag])
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), tag):
            end = page.find(">", tag)
            at = n if end < 0 else end + 1
            continue
        closing = page.startswith("/", tag + 1)
        name = _NAME.match(page, tag + 1 + closing)
        rest = _REST.match(page, name.end()) if name else None
        if rest is None:
            short = page.find(">", tag) if name else -1
            if short < 0:
                reader.data("<")
                at = tag + 1
                continue
            at, attributes = short + 1, page[name.end() : short]  # a quote without an end
        else:
            at, attributes = rest.end(), rest.group()[:-1]
        kind = name.group().lower()
        if closing:
            reader.end(kind)
        elif kind in RAW:
            end = re.compile(f"</{kind}(?=[\\s/>])[^>]*>", re.I).search(page, at, last + 1)
            at = end.end() if end else n
        else:
            reader.start(kind, attributes)
    reader.flush()
    return reader.blocks


def density(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def first_label(block: Block, foreign: bool, level: int) -> str:
    """Label of a block by itself. ``foreign``: the page's language has no stop words here, so they don't count.

    In the part that the page marks as its article, only links speak against a block.
    """
    n = len(block.text)
    if block.apart or block.level < level:
        return BAD
    if block.link_chars > LINKS_MOST * n:
        return BAD
    if n < SHORT:
        return BRIEF
    stops = STOPS_HIGH if foreign else density(block.text)
    if stops >= STOPS_HIGH:
        return GOOD if n > LONG else NEAR
    return NEAR if stops >= STOPS_LOW or level else BAD


def nearest(labels: list[str | None]) -> list[tuple[int, str] | None]:
    """For every place the distance and label of the last decided place before it."""
    out, found = [], None
    for i, label in enumerate(labels):
        out.append((i - found[0], found[1]) if found else None)
        if label is not None:
            found = (i, label)
    return out


def inherited(blocks: list[Block], decided: set[str], marked: bool) -> dict[int, str]:
    """Labels of ambiguous blocks from their neighbours in ``decided``.

    The nearest one of the same container counts, else the nearest of all; at equal distance good wins in a container or
    for a heading before good text. In an article a block is good unless both neighbours are bad.
    """
    def around(part: list[int]) -> dict[int, tuple]:
        labels = [blocks[i].label if blocks[i].label in decided else None for i in part]
        before, after = nearest(labels), nearest(labels[::-1])[::-1]
        return dict(zip(part, zip(before, after, strict=True), strict=True))

    groups: dict[int, list[int]] = {}
    for i, b in enumerate(blocks):
        if not b.apart:
            groups.setdefault(b.container, []).append(i)
    near = {i: sides for part in groups.values() for i, sides in around(part).items()}
    far = around([i for i, b in enumerate(blocks) if not (marked and b.apart)])
    out = {}
    for i, b in enumerate(blocks):
        if b.label in decided or b.label == BAD:
            continue
        own = near.get(i, (None, None))
        sides = own if any(own) else far[i]
        found = sorted((s for s in sides if s), key=lambda s: s[0])
        if marked:
            out[i] = BAD if len(found) == 2 and all(s[1] == BAD for s in found) else GOOD
        elif not found:
            out[i] = GOOD if b.label == NEAR else BAD
        elif len(found) == 1 or found[0][0] < found[1][0] or found[0][1] == found[1][1]:
            out[i] = found[0][1]
        elif sides is own or b.label == NEAR:
            out[i] = GOOD
        else:
            out[i] = GOOD if b.heading and sides[1][1] == GOOD else BAD
    return out


def label(blocks: list[Block]) -> None:
    """Gives every block its label: good or bad.

    If the page marks an article, a main part or a part named as content that holds good text, only that part counts. On a
    page without good text short blocks without links are good.
    """
    own = [b for b in blocks if not b.apart]
    words = " ".join(b.text for b in own)
    foreign = density(words) < STOPS_LOW
    for level in (3, 2, 1, 0):
        if level and not any(b.level >= level for b in own):
            continue
        for b in blocks:
            b.label = first_label(b, foreign, level)
        brief = [b for b in own if b.label == BRIEF]
        for decided in ({GOOD, BAD}, {GOOD, BAD, NEAR}):  # near good ones first, then short ones beside them
            for i, found in inherited(blocks, decided, level > 0).items():
                if blocks[i].label == NEAR or NEAR in decided:
                    blocks[i].label = found
        for b in blocks:
            b.label = GOOD if b.label == GOOD else BAD
        if any(b.label == GOOD for b in blocks):
            return
    for b in brief:  # nothing but short blocks
        b.label = BAD if b.link_chars else GOOD


def main_text(page: str | None) -> str:
    blocks = read_blocks(page or "")
    label(blocks)
    return "\n\n".join(b.text for b in blocks if b.label == GOOD)


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, the main text and its length in code points.

    White space inside a block is one space; blocks are joined by an empty line, in page order. A null or empty page, or one
    without main text, has an empty text. Null ids and urls stay null; repeated rows are returned as often as they occur; an
    empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py()) for x in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id bigint, url string, text string").withColumn("n_chars", F.length("text").cast("bigint"))


def labelled_blocks(pages: DataFrame) -> DataFrame:
    """One row per block: page_id, url, its number, text, share of characters in links, and whether it is main text."""
    schema = "page_id bigint, url string, block int, text string, link_share double, good boolean"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page, url, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                blocks = read_blocks(raw or "")
                label(blocks)
                n = len(blocks)
                columns = [
                    pa.array([page] * n, pa.int64()), pa.array([url] * n, pa.string()), pa.array(range(n), pa.int32()),
                    pa.array([b.text for b in blocks], pa.string()),
                    pa.array([b.link_chars / len(b.text) for b in blocks], pa.float64()), pa.array([b.label == GOOD for b in blocks], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInArrow(run, schema)
