"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block elements, in one pass with a stack of open elements. Parts that are boilerplate by their
element or by their class, id or role are left out, but never the page itself, its article, or a part that holds most of what
there is to read. The other blocks are judged by length, stop-word density and link density; short and undecided ones take
the label of the nearest decided block. Where a page marks its article, only blocks inside are candidates, unless the greater
part of its main text stands outside. On pages in none of the languages with stop words, length and link density decide alone.

Every step takes time in proportion to the page: tags are found from left to right, each element is opened and closed once,
and where something unclosed is looked for in vain, that is remembered.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.shared import small_batches

SHORT, LONG = 70, 200
STOPS_LOW, STOPS_HIGH = 0.20, 0.32
LINKS_MOST = 0.5

#: Frequent function words of English, German, French and Spanish.
LANGUAGES = tuple(frozenset(words.split()) for words in (
    """the of and to a in is it that for was on are as with his they be at one have this from or had by not but what all were we
when your can said there an which their if will how about out them these so her would him has more no""",
    """der die das und in zu den von mit ist des im für auf dem nicht ein eine als auch es an werden aus er hat dass sie nach wird
bei einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis mehr durch man sein sich""",
    """le la les de des du un une et est en que qui dans pour pas au sur plus par ce il elle ne se avec son sont ou mais nous vous
leur aux comme été cette ces même si tout fait""",
    """el los las un una y en es que por con para se del al lo como más pero sus su le ya o fue este ha sí porque esta son entre
está cuando muy sin sobre ser tiene también me hasta hay donde han quien están""",
))
STOP_WORDS = frozenset().union(*LANGUAGES)

#: Elements that never hold main text (a caption only inside an article), those of them that whole
#: pages are put into, those whose content is no text of the page, and those whose content is not markup.
DROPPED = frozenset("nav footer aside form select button menu dialog datalist label fieldset".split())
FRAMES = frozenset("form fieldset label".split())
EMBEDDED = frozenset("noscript template svg object canvas audio video head".split())
RAW = frozenset("script style textarea title iframe".split())
#: Parts that are never boilerplate as a whole, and that end a navigation which is still open.
KEPT = frozenset("html body main article".split())
#: Start tags that end an svg which is still open.
BREAKOUT = frozenset(
    "article b big blockquote body br center code dd div dl dt em h1 h2 h3 h4 h5 h6 hr i img li main menu ol p pre ruby s section"
    " small span strike strong sub sup table tt u ul var".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre section summary table tbody td"
    " tfoot th thead title tr ul".split())
CLOSED_BY_NEXT = frozenset("p li dt dd tr td th option thead tbody tfoot".split())
#: Words that a class, id or role of boilerplate is, begins or ends with; those of readers' comments; and first
#: parts of a name that say something else about the word that follows.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr"
    " notice notices alert newsletter subscribe subscription signup login paywall popup modal overlay sidebar sidebars rail menu menus"
    " nav navbar navigation breadcrumb breadcrumbs pager pagination footer masthead comment comments disqus respond reply replies"
    " share sharing social related recommended recommendations widget widgets toolbar search skip complementary contentinfo"
    .split())
COMMENTS = frozenset("comment comments disqus respond reply replies".split())
OTHERWISE = frozenset(
    "no not non without has have with is hide category cat tag tags type format term topic post-type single page-template".split())

NAME = re.compile(r"[A-Za-z][^\s/>]*+")
PLAIN = re.compile(r"[^>\"']*+")
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
SPACES = re.compile(r"\s+")
BREAK = "\x00"


@dataclass
class Block:
    text: str
    links: int
    inside: bool

    def words(self) -> list[str]:
        return [w.strip(".,;:!?\"'()") for w in self.text.lower().split()]

    def linked(self) -> bool:
        return self.links / max(len(self.text), 1) > LINKS_MOST

    def reads(self) -> bool:
        """Whether it is text in one of the languages with stop words."""
        if len(self.text) < SHORT or self.linked():
            return False
        words = self.words()
        return any(sum(w in language for w in words) >= STOPS_LOW * len(words) for language in LANGUAGES)

    def label(self, known: bool = True) -> bool | None:
        """Main text or not; None if its own length, stop words (if the page's language is known) and links do not decide."""
        if self.linked():
            return False
        if len(self.text) < SHORT:
            return None
        if not known:
            return True if len(self.text) >= LONG else None
        words = self.words()
        stops = sum(w in STOP_WORDS for w in words) / len(words)
        if stops >= STOPS_HIGH or (stops >= STOPS_LOW and (len(self.text) >= LONG or self.inside)):
            return True
        return None if self.inside or stops >= STOPS_LOW or len(self.text) < LONG else False


def hinted(name: str) -> str | None:
    """The word of boilerplate that one class or id is, begins or ends with; None where another word turns it."""
    if name.lower() in HINTS:
        return name.lower()
    parts = [p.lower() for p in PARTS.findall(name)]
    if len(parts) < 2 or parts[0] in OTHERWISE:
        return None
    return next((p for p in (parts[0], parts[-1]) if p in HINTS), None)


def _hints(attributes: str) -> tuple[bool, set[str]]:
    """Whether an element is hidden, and the words of boilerplate in its class, id and role."""
    hidden, words = False, set()
    for found in ATTRIBUTE.finditer(attributes):
        name, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and HIDING.search(value):
            hidden = True
        elif name in ("class", "id", "role"):
            words.update(filter(None, map(hinted, value.split())))
    return hidden, words


@dataclass
class Part:
    """An open or closed element that may be boilerplate with all it holds."""

    parent: Part | None
    first: int  # blocks before it
    frame: bool  # may be the frame of a page that marks no article
    plain: int  # characters outside of links before it; when it is closed, inside
    closed: bool = False  # by its own end tag
    main: int | None = None  # blocks before the article that begins inside
    drops: bool = False  # with all it holds
    upto: int = 0  # or else up to that block

    def decide(self, whole: int, marked: bool) -> None:
        """Left out, unless it holds the greater part of the page's plain text and the article, or that part of a page which marks no
        article: then it is the page's frame. What was never closed ends where an article begins."""
        frame = 2 * self.plain > whole and (self.main is not None or self.frame and not marked)
        half = self.main is not None and not self.closed
        above = self.parent
        self.drops = not frame and not half or above is not None and above.drops
        self.upto = max(self.main if half and not frame else 0, above.upto if above is not None else 0)


class _Tags:
    """Tags of a page from left to right."""

    def __init__(self, html: str):
        self.html = html
        self.lacking: set[str] = set()  # ends that do not occur behind some place already passed

    def find(self, what: str, at: int) -> int:
        """The next place of ``what``, or -1."""
        if what in self.lacking:
            return -1
        found = self.html.find(what, at)
        if found < 0:
            self.lacking.add(what)
        return found

    def end_of(self, at: int) -> int:
        """Behind the ``>`` that ends the tag whose attributes begin at ``at``; a quote that never closes is a character."""
        html, size = self.html, len(self.html)
        while True:
            at = PLAIN.match(html, at).end()
            if at >= size:
                return size
            if html[at] == ">":
                return at + 1
            close = self.find(html[at], at + 1)
            at = at + 1 if close < 0 else close + 1

    def behind(self, what: str, at: int) -> int:
        """Behind ``what``, or where it never comes, behind the next ``>``."""
        found = self.find(what, at)
        if found >= 0:
            return found + len(what)
        found = self.find(">", at)
        return found + 1 if found >= 0 else len(self.html)

    def raw_end(self, name: str, at: int) -> int:
        """Behind the end tag of a raw element; a script or style without one takes the rest, another is empty."""
        key = f"</{name}"
        if key not in self.lacking:
            found = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(self.html, at)
            if found:
                return self.end_of(found.end())
            self.lacking.add(key)
        return len(self.html) if name in ("script", "style", "textarea") else at


class _Page:
    """The blocks of a page, as its tags go by."""

    def __init__(self):
        self.blocks: list[tuple[Block, Part | None]] = []
        self.text: list[str] = []
        self.links = self.breaks = self.anchors = self.articles = self.embedded = 0
        self.plain = 0  # characters outside of links so far
        # Open elements: name, the part they belong to, whether they are an article, embedded content or a block.
        self.stack: list[tuple[str, Part | None, bool, bool, bool]] = []
        self.places: dict[str, list[int]] = {}
        self.open_blocks: list[int] = []
        self.parts: list[Part] = []
        self.part: Part | None = None

    def say(self, said: str) -> None:
        if not said or self.embedded:
            return
        self.text.append(said)
        size = len(said) if said.isspace() else len(SPACES.sub(" ", said))
        if not said.isspace():
            self.breaks = 0
            self.plain += 0 if self.anchors else size
        if self.anchors:
            self.links += size

    def line(self) -> None:
        if not self.embedded:
            self.breaks += 1
            self.text.append(" " if self.breaks < 2 else BREAK)

    def flush(self) -> None:
        whole = "".join(self.text)
        self.text.clear()
        for piece in whole.split(BREAK):
            clean = SPACES.sub(" ", entities.unescape(piece)).strip()
            if clean:
                self.blocks.append((Block(clean, min(self.links, len(clean)), self.articles > 0), self.part))
        self.links = self.breaks = 0

    def open(self, name: str, attributes: str) -> None:
        if self.embedded and name in BREAKOUT:
            svg, foreign = self.places.get("svg"), self.places.get("foreignobject")
            if svg and not (foreign and foreign[-1] > svg[-1]):
                self.close("svg", False)
        if self.open_blocks and name in BLOCK:
            top = self.stack[self.open_blocks[-1]][0]
            if top == "p" or top == name and name in CLOSED_BY_NEXT:
                self.close(top, False)
        if name == "body" and self.places.get("head"):
            self.close("head", False)
        main = name in ("article", "main") and not self.embedded
        if main:
            part = self.part
            while part is not None and part.main is None:
                part.main = len(self.blocks)
                part = part.parent
        elif name not in KEPT and not self.embedded:
            hidden, words = _hints(attributes) if attributes else (False, set())
            by_name = name in DROPPED or name in ("header", "figcaption") and not self.articles
            if hidden or words or by_name:
                frame = not hidden and words.isdisjoint(COMMENTS) and (name in FRAMES or not by_name)
                self.part = Part(self.part, len(self.blocks), frame, self.plain)
                self.parts.append(self.part)
        embedded = name in EMBEDDED
        self.places.setdefault(name, []).append(len(self.stack))
        if name in BLOCK:
            self.open_blocks.append(len(self.stack))
        self.stack.append((name, self.part, main, embedded, name in BLOCK))
        self.articles += main
        self.embedded += embedded

    def close(self, name: str, tag: bool = True) -> None:
        """Close the innermost element of that name, and all inside of it; without one nothing happens."""
        place = self.places.get(name)
        if not place:
            return
        for i in range(len(self.stack) - 1, place[-1] - 1, -1):
            inner, part, main, embedded, block = self.stack.pop()
            self.places[inner].pop()
            if block:
                self.open_blocks.pop()
            self.articles -= main
            self.embedded -= embedded
            outer = self.stack[-1][1] if self.stack else None
            if part is not outer:
                part.plain = self.plain - part.plain
                part.closed = tag and inner == name and not self.stack[len(self.stack):]
            self.part = outer

    def kept(self) -> list[Block]:
        """Blocks outside of boilerplate, once the page is over."""
        self.flush()
        while self.stack:
            self.close(self.stack[-1][0], False)
        marked = any(b.inside and part is None for b, part in self.blocks)
        for part in self.parts:  # those around a part come before it
            part.decide(self.plain, marked)
        return [b for i, (b, part) in enumerate(self.blocks) if part is None or not (part.drops or i < part.upto)]


def blocks_of(html: str) -> list[Block]:
    """Candidate blocks in page order, boilerplate parts left out."""
    page, tags = _Page(), _Tags(html)
    at, start, size = 0, 0, len(html)
    while (at := html.find("<", at)) >= 0:
        following = html[at + 1: at + 2]
        closing = following == "/"
        found = NAME.match(html, at + 1 + closing)
        if not found and following not in ("!", "?"):
            at += 1
            continue
        page.say(html[start: at])
        if not found:
            if html.startswith("<!--", at):
                at = tags.behind("-->", at + 4)
            elif html.startswith("<![CDATA[", at):
                at = tags.behind("]]>", at + 9)
            else:
                at = tags.behind(">", at)
            start = at
            continue
        name, at = found[0].lower(), tags.end_of(found.end())
        attributes = html[found.end(): at].removesuffix(">")
        start = at
        if name == "br":
            page.line()
            continue
        if name in BLOCK:
            page.flush()
        if closing:
            if name == "a":
                page.anchors = 0
            else:
                page.close(name)
        elif name in RAW:
            at = start = tags.raw_end(name, at)
        elif name == "a":
            page.anchors = 1
        elif name not in VOID and not (attributes.rstrip().endswith("/") and name not in KEPT):
            page.open(name, attributes)
    if start < size:
        page.say(html[start:])
    return page.kept()


def _articles(blocks: list[Block], known: bool) -> bool:
    """Whether the blocks inside articles are the page's text: not where most of what reads as text stands outside."""
    inside = sum(len(b.text) - b.links for b in blocks if b.inside)
    return inside > 0 and 2 * inside >= sum(len(b.text) for b in blocks if not b.inside and b.label(known))


#: So many blocks of links one after the other are a menu, also inside an article; fewer are paragraphs.
MENU = 3


def extract(html: str) -> str:
    """The main text: its blocks joined by two line feeds."""
    blocks = blocks_of(html)
    if _articles(blocks, any(b.reads() for b in blocks)):
        blocks = [b for b in blocks if b.inside]
    else:
        blocks = [Block(b.text, b.links, False) for b in blocks]
    known = any(b.reads() for b in blocks)
    labels = [b.label(known) for b in blocks]
    for linked, run in groupby(range(len(blocks)), lambda i: blocks[i].inside and blocks[i].linked()):
        places = list(run)
        if linked and len(places) < MENU:
            for i in places:
                labels[i] = None
    if not known and True not in labels:
        # No long block in an unknown language: those of middle length are its text.
        labels = [True if d is None and len(b.text) >= SHORT else d for b, d in zip(blocks, labels)]
    decided = [i for i, d in enumerate(labels) if d is not None]
    if not decided:
        return "\n\n".join(b.text for b in blocks)
    before: list[int | None] = []
    last = None
    for i, d in enumerate(labels):
        last = i if d is not None else last
        before.append(last)
    keep, following = [False] * len(blocks), None
    for i in range(len(blocks) - 1, -1, -1):
        if labels[i] is not None:
            following, keep[i] = i, bool(labels[i])
            continue
        near = [(abs(i - n), not labels[n]) for n in (before[i], following) if n is not None]
        keep[i] = not min(near)[1]
    return "\n\n".join(b.text for b, k in zip(blocks, keep) if k)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(h.as_py() or "") for h in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages (page_id, url, html)``.

    Null and empty pages, and pages of boilerplate alone, have an empty text; null ids and addresses and repeated rows are kept.
    An empty table gives an empty result. Other columns are not read.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
