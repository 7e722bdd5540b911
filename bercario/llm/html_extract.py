"""Main text of web pages, by block rules in two passes.

Markup is read into blocks: text between tags that break lines, with how much of it stands in
links and in which parts of the page it lies. Parts that are never the article go first: menus,
headers, footers, sidebars and the like by tag or role, hidden ones, adverts, notices, reader comments
by whole names in class or id, forms. Four things overrule that, as tags and names are often wrong:

* an element that its own end tag does not end is no part of the page but a slip;
* a form, or a part with such a name, that holds more prose than all the rest is the article. Text
  marked as article is not beaten by parts outside it, and a form around it is only a wrapping;
* an article is never dropped for its name, unless it is one of reader comments beside another;
* a header inside an article is the article's.

If an article is marked (``article``, else ``main``), its blocks are the text and nothing else is; a mark
without any prose on a page with prose counts for nothing. On other pages the rules decide.

First pass, each block for itself: many links make it bad; much text with many stop words makes it
good; little text, or few stop words, leaves it undecided, or bad if it is long without any. Second
pass: an undecided block takes the label of its nearest decided neighbours, the good one if they
differ at equal distance; without any decided neighbour it is kept. The stop words, which are of four
languages, count only if blocks with many of them hold at least as much text as blocks without;
otherwise the page is taken to be in another language, and length and links alone decide.

Character references are decoded, white space inside a block is one space, blocks are joined by an
empty line.

Defined results: a null, empty or text-free page gives an empty text. Broken markup is read as far
as it goes: an unclosed element ends with its parent, an unclosed script or comment with the page, a
head with the first element of a body. Every row gives one row, ids repeated, null or not. Other
columns are not read.
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

# Element names of the HTML standard.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main"
    " menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe template svg object".split())
NEVER = frozenset(
    "head nav header footer aside button select option menu dialog canvas audio video"
    " label fieldset".split()
)
IN_HEAD = frozenset("html head title base link meta style script noscript template".split())
ARTICLE = "article"
NEVER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu menubar".split()
)
# Words that pages give to parts that are not the article, the words that go with them
# in a name, and those of reader comments.
_BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors"
    " promo promos promotion banner banners nav navbar navigation menu menus submenu breadcrumb"
    " breadcrumbs sidebar footer foot header masthead cookie cookies consent gdpr notice notices"
    " newsletter subscribe subscription signup popup modal overlay share sharing shares social related"
    " recommend recommended recommendation recommendations widget widgets toolbar pagination pager"
    " login search skip".split()
)
_COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies".split())
_WITH_WORDS = frozenset(
    "site page global top bottom left right upper lower first last main primary secondary side bar box"
    " block slot unit area zone section container wrapper wrap holder inner outer content list items item"
    " links link buttons button icons icon form text thread unit group row col column panel posts post"
    " by to us on in the a e".split()
)

# Frequent words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "the of and to in a is that for it with as was on be by this are from at or an which but not"
    " der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch es an werden"
    " le la les de des et un une du en que qui dans pour par sur au plus ne pas est avec"
    " el los las y del se por con una su para al lo como más o".split()
)

LINK_SHARE = 0.4
SHORT_CHARS = 60
LONG_CHARS = 200
STOP_LOW = 0.05
STOP_HIGH = 0.12

# A comment, a declaration, or a tag of no more than 999 pieces. What cannot be closed is text or runs
# to the end.
_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:--!?>|\Z)|<[!?][^>]*+>?"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+'|[\"'<]){0,999}?)>",
    re.S,
)
# A name and a value, from the front: what stands in quotes is never taken for a name.
_ATTRIBUTE = re.compile(r"[\s/]*+([^\s/=][^\s/=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s]*+)))?")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_WORDS = re.compile(r"[a-z]+|[0-9]+")
_SAYS = re.compile("class|id|role|hidden|style", re.I)

BY_TAG, BY_NAME, FORM, COMMENT = "tag", "name", "form", "comment"


@dataclass(eq=False)
class Part:
    """A part of the page that may not belong to the article, and whether it ended as it should.

    An inline part has no blocks of its own but a place in one: ``begin`` is where.
    """

    kind: str
    is_article: bool = False
    in_article: bool = False
    in_main: bool = False
    begin: tuple[int, int, int] | None = None
    outer: Part | None = None
    closed: bool = False


@dataclass
class Block:
    text: str
    link_chars: int
    in_article: bool = False
    in_main: bool = False
    part: Part | None = None
    label: str = ""

    @property
    def prose(self) -> int:
        size = len(self.text)
        return size if size >= SHORT_CHARS and self.link_chars <= LINK_SHARE * size else 0


@dataclass
class _Reader:
    blocks: list[Block] = field(default_factory=list)
    open: list[tuple[str, Part | None]] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    links: int = 0
    articles: int = 0
    mains: int = 0
    link_parts: list[str] = field(default_factory=list)
    # Parts of the page: all, outer ones first, and the innermost one that is open.
    found: list[Part] = field(default_factory=list)
    inner: Part | None = None
    names: Counter = field(default_factory=Counter)

    def text(self, raw: str) -> None:
        if raw:
            decoded = html.unescape(raw)
            self.parts.append(decoded)
            if self.links:
                self.link_parts.append(decoded)

    def end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                linked = len(" ".join("".join(self.link_parts).split()))
                self.blocks.append(Block(text, linked, self.articles > 0, self.mains > 0, self.inner))
            self.parts, self.link_parts = [], []

    def take_back(self, part: Part) -> None:
        """What an inline part has added to the block that goes on behind it."""
        blocks, parts, links = part.begin
        if len(self.blocks) > blocks:
            self.end_block()
        else:
            del self.parts[parts:], self.link_parts[links:]

    def start(self, name: str, rest: str) -> None:
        if name not in IN_HEAD and self.open and self.open[-1][0] == "head":
            self.close("head")
        if name in BLOCK:
            self.end_block()
            if self.open and self.open[-1][0] == "p":
                self.close("p")
        elif name == "br":
            self.text(" ")
        if name in VOID or rest.endswith("/"):
            return
        kind = part_kind(name, rest, self.articles > 0)
        part = None
        if kind:
            begin = None if name in BLOCK else (len(self.blocks), len(self.parts), len(self.link_parts))
            part = Part(kind, name == ARTICLE, self.articles > 0, self.mains > 0, begin, self.inner)
            self.found.append(part)
            self.inner = part
        self.open.append((name, part))
        self.names[name] += 1
        self.links += name == "a"
        self.articles += name == ARTICLE
        self.mains += name == "main"

    def close(self, name: str) -> None:
        if name in BLOCK:
            self.end_block()
        if not self.names[name]:
            return
        at = len(self.open) - 1
        while at >= 0 and self.open[at][0] != name:
            # An inline element is not closed across the block that holds it.
            if name not in BLOCK and self.open[at][0] in BLOCK:
                return
            at -= 1
        ended = self.open[at][1]
        if ended:
            ended.closed = True
            if ended.begin:
                self.take_back(ended)
        outermost = next((part for _, part in self.open[at:] if part), None)
        if outermost:
            self.inner = outermost.outer
        for opened, _ in self.open[at:]:
            self.names[opened] -= 1
            self.links -= opened == "a"
            self.articles -= opened == ARTICLE
            self.mains -= opened == "main"
        del self.open[at:]


def attributes(rest: str) -> dict[str, str]:
    """Names and values inside a tag; of a name that repeats, the first counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), html.unescape("".join(values)))
    return found


def name_kind(value: str) -> str:
    """What a class or id says: every word of one whole name is of parts that are not the article."""
    for name in value.lower().split():
        words = _WORDS.findall(name)
        bad = [word for word in words if word in _BAD_WORDS]
        comments = [word for word in words if word in _COMMENT_WORDS]
        others = len(words) - len(bad) - len(comments)
        with_them = sum(word in _WITH_WORDS or word.isdigit() for word in words)
        if (bad or comments) and others == with_them:
            return COMMENT if comments else BY_NAME
    return ""


def part_kind(name: str, rest: str, in_article: bool) -> str:
    """The kind of part that an element begins, empty if it may well be the article's."""
    if name in ("html", "body", "main"):
        return ""
    heading = name == "header" and in_article
    if name in NEVER and not heading:
        return BY_TAG
    if not _SAYS.search(rest):
        return FORM if name == "form" else ""
    has = attributes(rest)
    hidden = "hidden" in has and has["hidden"].lower() != "until-found"
    if hidden or has.get("aria-hidden", "").lower() == "true" or _NOT_SHOWN.search(has.get("style", "")):
        return BY_TAG
    if has.get("role", "").lower() in NEVER_ROLES and name not in (ARTICLE, "form"):
        return BY_TAG
    named = {name_kind(has[where]) for where in ("class", "id") if where in has}
    if COMMENT in named:
        return COMMENT
    if name == "form":
        return FORM
    return BY_NAME if BY_NAME in named and name != ARTICLE and not heading else ""


def blocks_of(page: str) -> tuple[list[Block], list[Part]]:
    """All blocks of a page in order, and its parts, outer ones first."""
    reader = _Reader()
    at = 0
    while True:
        token = _TOKEN.search(page, at)
        if token is None:
            break
        reader.text(page[at : token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        if token["close"]:
            reader.close(name)
        elif name in RAW and not token["rest"].endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            if name in BLOCK:
                reader.end_block()
        else:
            reader.start(name, token["rest"])
    reader.text(page[at:])
    reader.end_block()
    return reader.blocks, reader.found


def _stop_share(text: str) -> float:
    words = re.findall(r"[^\W\d_]+", text.lower())
    return sum(word in STOP_WORDS for word in words) / max(len(words), 1)


def without_parts(blocks: list[Block], parts: list[Part]) -> list[Block]:
    """The blocks that no part speaks against, or only one that is overruled."""
    comments: dict[Part | None, bool] = {None: False}
    for part in parts:
        comments[part] = comments[part.outer] or (part.closed and part.kind == COMMENT)
    article = any(block.in_article and not comments[block.part] for block in blocks)
    # An article of comments is the article if there is no other.
    against = [p for p in parts if p.closed and (article or not (p.is_article and p.kind == COMMENT))]
    wrapping = _wrappings(blocks, parts, set(against))
    against = set(against) - wrapping
    # How many parts speak against what lies in a part (up to two), and the only one.
    count: dict[Part | None, int] = {None: 0}
    only: dict[Part | None, Part | None] = {None: None}
    for part in parts:
        count[part] = min(2, count[part.outer] + (part in against))
        only[part] = part if part in against else only[part.outer]
    free = [block for block in blocks if not count[block.part]]
    rest, marked = sum(block.prose for block in free), any(b.in_article or b.in_main for b in free)
    held: dict[Part, int] = {}
    for block in blocks:
        part = only[block.part]
        if count[block.part] == 1 and part.kind in (BY_NAME, FORM) and (not marked or block.in_article or block.in_main):
            held[part] = held.get(part, 0) + block.prose
    overruled = {part for part, prose in held.items() if prose >= LONG_CHARS and prose > rest}
    return [b for b in blocks if not count[b.part] or (count[b.part] == 1 and only[b.part] in overruled)]


def _wrappings(blocks: list[Block], parts: list[Part], against: set[Part]) -> set[Part]:
    """Forms around a marked article that nothing else speaks against."""
    other: dict[Part | None, bool] = {None: False}
    for part in parts:
        other[part] = other[part.outer] or (part in against and part.kind != FORM)
    found, seen = set(), set()
    for block in blocks:
        part = block.part
        while part and not other[block.part] and (part, block.in_article, block.in_main) not in seen:
            seen.add((part, block.in_article, block.in_main))
            if part.kind == FORM and (block.in_article > part.in_article or block.in_main > part.in_main):
                found.add(part)
            part = part.outer
    return found


def _marked(blocks: list[Block]) -> list[bool]:
    """Which blocks are marked as the article; none, if the mark is on no prose and others have some."""
    for flags in ([b.in_article for b in blocks], [b.in_main for b in blocks]):
        inside = [b for b, flag in zip(blocks, flags, strict=True) if flag]
        outside = sum(b.prose for b, flag in zip(blocks, flags, strict=True) if not flag)
        if inside and (any(b.prose for b in inside) or outside < LONG_CHARS):
            return flags
    return [False] * len(blocks)


def decide(blocks: list[Block]) -> None:
    """The label of every block: good or bad."""
    flags = _marked(blocks)
    if any(flags):
        for block, flag in zip(blocks, flags, strict=True):
            block.label = "good" if flag else "bad"
        return
    stops = [_stop_share(block.text) for block in blocks]
    with_stops = without = 0
    for block, stop in zip(blocks, stops, strict=True):
        with_stops += block.prose * (stop >= STOP_HIGH)
        without += block.prose * (stop < STOP_HIGH)
    other_language = with_stops < without
    for block, stop in zip(blocks, stops, strict=True):
        size = len(block.text)
        if block.link_chars > LINK_SHARE * size:
            block.label = "bad"
        elif size >= SHORT_CHARS and (stop >= STOP_HIGH or other_language):
            block.label = "good"
        elif size >= LONG_CHARS and stop < STOP_LOW:
            block.label = "bad"
    distance = len(blocks) + 1
    before: list[tuple[int, str]] = []
    last = (distance, "")
    for block in blocks:
        last = (0, block.label) if block.label else (last[0] + 1, last[1])
        before.append(last)
    last = (distance, "")
    labels = [block.label for block in blocks]
    for i in range(len(blocks) - 1, -1, -1):
        last = (0, labels[i]) if labels[i] else (last[0] + 1, last[1])
        if not labels[i]:
            near = [x for x in (before[i], last) if x[1]]
            nearest = min((x[0] for x in near), default=0)
            votes = {x[1] for x in near if x[0] == nearest}
            blocks[i].label = "good" if "good" in votes or not votes else "bad"


def main_text(page: str | None) -> str:
    """The text of the article."""
    blocks = without_parts(*blocks_of(page or ""))
    decide(blocks)
    return "\n\n".join(block.text for block in blocks if block.label == "good")


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("body")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            columns = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            names = ["page_id", "url", "text", "n_chars"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names)

    id_type, url_type = (rows.schema[name].dataType.simpleString() for name in ("page_id", "url"))
    return rows.mapInArrow(work, f"page_id {id_type}, url {url_type}, text string, n_chars long")
