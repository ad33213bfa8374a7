"""Main text of web pages as the maximum-scoring run of page tokens.

Words score positive and tags negative, by weights estimated from labelled pages; one scan finds the
contiguous region of greatest sum, which is widened to whole blocks and to the article element around it.
Elements whose class or id only sounds like boilerplate are judged by what they hold: see ``_spared``.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardspark.llm.common import hash60, text_of
from wardspark.session import ship_package, stage

LABELLED = 2_000  # labelled pages that the weights are estimated from, at most

#: Names of HTML elements by what they mean for a page's text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
BOILERPLATE = frozenset(
    "head nav aside footer button select dialog menu script style noscript template textarea title iframe svg math "
    "object canvas audio video".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
MAIN = frozenset(("article", "main"))
HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor|sponsored|promo|promotion|banner|sidebar|side|menu|nav|"
    r"navbar|navigation|breadcrumbs?|footer|header|masthead|topbar|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|"
    r"newsletter|subscribe|subscription|signup|paywall|share|sharing|social|related|recommended|recommendations|comments?|"
    r"disqus|replies|reply|respond|login|search|pagination|pager|toolbar|widget|skip|copyright|legal)(?:$|[\s_-])",
    re.I,
)
#: Names that tell of a hinted part elsewhere on the page (has-sidebar), and headings of a text (entry-header).
NO_HINT = re.compile(r"(?:has|no|with|without|hide|show)[_-].*|(?:.*[_-])?(?:entry|post|article|story|content|page)[_-]+header(?:[_-].*)?", re.I)
#: Words for a place or a look: inside an article they name parts of the text too.
PLACE = frozenset("alert banner header legal notice notices side sidebar social widget".split())
COMMENT = re.compile(r"(?:^|[_-])(?:comments?|disqus|replies|reply|respond)(?:$|[_-])", re.I)
#: Elements that a start tag ends, when they are open without an end tag.
IMPLIED = {"p": frozenset(("p",)), "li": frozenset(("li", "p")), "dt": frozenset(("dt", "dd", "p")), "dd": frozenset(("dt", "dd", "p")),
           "tr": frozenset(("tr", "td", "th", "p")), "td": frozenset(("td", "th", "p")), "th": frozenset(("td", "th", "p")),
           "option": frozenset(("option",))}
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r">|=\s*([\"'])")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Piece(NamedTuple):
    """A tag (``tag`` set) or a run of text; ``block`` numbers the block it lies in, ``main`` the article around it."""

    tag: str
    text: str
    block: int
    main: int
    context: str
    hinted: bool = False  # in an element that sounds like boilerplate and holds no main text


class Hinted:
    """An element whose names sound like boilerplate, with the words it holds; ``outer``: names that none around it has."""

    def __init__(self, names: frozenset[str], inside_main: bool, parent: Hinted | None, outer: frozenset[str]):
        found = {w for n in names for w in re.split("[_-]+", n) if HINT.search(w)}
        self.names, self.placed = names, inside_main and "<form>" not in names and found <= PLACE
        self.parent, self.outer = parent, outer
        self.words, self.linked, self.marked, self.bad = 0, 0, 0, False


def _boilerplate(name: str, attributes: str, inside_main: bool) -> bool | frozenset[str]:
    """Whether an element is boilerplate for certain; else its names that sound like it, if any."""
    if name in BOILERPLATE:
        return True
    if name == "header" and not inside_main:
        return True
    own = frozenset(("<form>",)) if name == "form" else frozenset()
    if not attributes.strip() or name in ("html", "body", "main"):
        return own
    found = {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        return True
    role = found.get("role", "").lower()
    if role in ROLES:
        return True
    named = f"{found.get('class', '')} {found.get('id', '')}"
    if name == "article":
        return bool(re.search(r"(?:^|[\s_-])(?:comments?|reply|replies|ads?|related|promo)(?:$|[\s_-])", named, re.I))
    if role == "form":
        own = frozenset(("<form>",))
    if HINT.search(named):
        own |= {n.lower() for n in named.split() if HINT.search(n) and not NO_HINT.fullmatch(n)}
    return own


def _judge(out: list[Piece], around: list[Hinted | None], hinted: list[Hinted]) -> None:
    """Mark the hinted elements that are boilerplate, or lie in one that is.

    A name is no hint on a page where its elements hold most of the words, or half of the words of article and
    main elements; an element is spared if one of its names is. Where an article lies elsewhere, words count only if they
    are ten times as many as the article's, and comments not at all. Inside an article, an element named after a place or a look is spared unless most of its words are links.
    """
    everything = inside = 0
    for piece, element in zip(out, around):
        if not piece.context:
            continue
        n = len(piece.text.split())
        everything += n
        inside += n if piece.main else 0
        if element:
            element.words += n
            element.linked += n if piece.context == "a" else 0
            element.marked += n if piece.main else 0
    words: Counter = Counter()
    marked: Counter = Counter()
    for element in reversed(hinted):  # inner elements come after those around them
        if element.parent:
            element.parent.words += element.words
            element.parent.linked += element.linked
            element.parent.marked += element.marked
        for name in element.outer:
            words[name] += element.words
            marked[name] += element.marked
    good = {
        x for x in words
        if inside and 2 * marked[x] >= inside or 2 * words[x] > everything and (not inside or words[x] > 10 * inside and not COMMENT.search(x))
    }
    for element in hinted:
        spared = element.names & good or element.placed and 2 * element.linked < element.words
        element.bad = not spared or element.parent is not None and element.parent.bad


class Token(NamedTuple):
    """A tag, or (without a name) a comment or declaration; ``ended`` is false where the page breaks off in it."""

    start: int
    end: int
    closing: bool
    name: str
    attributes: str
    ended: bool


class Reader:
    """The tags of a page one after another, each character looked at a bounded number of times.

    A quote opens a value only after an equals sign, and only where it is closed again; any other quote is a character like
    others. So a tag with a stray quote ends at its ``>``.
    """

    def __init__(self, html: str):
        self.html, self.at = html, 0
        self.last = {q: html.rfind(q) for q in "\"'"}

    def next(self, raw: str) -> Token | None:
        """The next token; within the raw text of an element (``raw``) its end tag and nothing else."""
        html = self.html
        if raw:
            found = re.compile(f"</{re.escape(raw)}(?=[\\s/>]|$)", re.I).search(html, self.at)
            if not found:
                return None
            return self._tag(_TAG.match(html, found.start()))
        while (start := html.find("<", self.at)) >= 0:
            for opening, closing in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">")):
                if html.startswith(opening, start):
                    end = html.find(closing, start + len(opening))
                    self.at = len(html) if end < 0 else end + len(closing)
                    return Token(start, self.at, False, "", "", True)
            if found := _TAG.match(html, start):
                return self._tag(found)
            self.at = start + 1
        return None

    def _tag(self, found: re.Match) -> Token:
        html, at = self.html, found.end()
        while stop := _STOP.search(html, at):
            at = stop.end()
            if not stop[1]:
                self.at = at
                return Token(found.start(), at, bool(found[1]), found[2].lower(), html[found.end():at - 1], True)
            if at <= self.last[stop[1]]:
                at = html.index(stop[1], at) + 1
        self.at = len(html)
        return Token(found.start(), self.at, bool(found[1]), found[2].lower(), "", False)


def pieces(html: str) -> list[Piece]:
    """The page's tags and texts in order, without what boilerplate elements hold; hinted ones are marked.

    The work is in proportion to the page, however deep its elements are nested and wherever it breaks off.
    """
    out: list[Piece] = []
    around: list[Hinted | None] = []   # innermost hinted element around each piece
    hinted: list[Hinted] = []
    hint: Hinted | None = None
    open_: list[tuple[str, int, Hinted | None]] = []  # name, article number and hinted element around it
    names: Counter = Counter()         # open elements by name
    blocks: list[str] = []             # open blocks
    sounding: Counter = Counter()      # names of open hinted elements
    dropped = 0                        # depth of open elements inside a boilerplate element, 0 outside
    block, mains, main, at, raw = 0, 0, 0, 0, ""
    reader = Reader(html)

    def add(piece: Piece) -> None:
        out.append(piece)
        around.append(hint)

    def text(until: int) -> None:
        if not dropped and until > at and not raw:
            run = html[at:until]
            if run.strip():
                context = "a" if names["a"] else blocks[-1] if blocks else "body"
                add(Piece("", entities.unescape(run), block, main, context))
            elif run:
                add(Piece("", " ", block, main, ""))

    def close() -> str:
        nonlocal main, hint, dropped
        name, main, before = open_.pop()
        names[name] -= 1
        if name in BLOCK:
            blocks.pop()
        if hint is not before:
            sounding.subtract(hint.names)
        hint = before
        dropped = max(0, dropped - 1)
        return name

    while token := reader.next(raw):
        text(token.start)
        raw = ""
        at = token.end
        name = token.name
        if not name:
            continue
        if not token.ended:
            at = len(html)
            break
        if not token.closing:
            ended = IMPLIED.get(name)
            while ended and open_ and open_[-1][0] in ended:
                close()
            if name in BLOCK and open_ and open_[-1][0] == "p":
                close()
            if name in BLOCK:
                block += 1
            judged = not dropped and _boilerplate(name, token.attributes, main > 0)
            unwanted = judged is True
            if not dropped and not unwanted:
                add(Piece(name, " " if name == "br" else "", block, main, ""))
            if name in VOID or token.attributes.rstrip().endswith("/") and name not in BLOCK:
                continue
            open_.append((name, main, hint))
            names[name] += 1
            if name in BLOCK:
                blocks.append(name)
            if dropped:
                dropped += 1
            elif unwanted:
                dropped = 1
            else:
                if judged:
                    hint = Hinted(judged, main > 0, hint, frozenset(n for n in judged if sounding[n] <= 0))
                    hinted.append(hint)
                    sounding.update(judged)
                if name in MAIN:
                    mains += 1
                    main = mains
            if name in RAW:
                raw = name
        elif names[name] > 0:
            hidden = dropped > 0
            while close() != name:
                pass
            if name in BLOCK:
                block += 1
            if not dropped and not hidden:
                add(Piece("/" + name, "", block, main, ""))
    text(len(html))
    if not hinted:
        return out
    _judge(out, around, hinted)
    return [p._replace(hinted=True) if e and e.bad else p for p, e in zip(out, around)]


class Weights(NamedTuple):
    words: dict[str, float]  # per word, by the block or link around it
    tags: dict[str, float]


#: Used where a corpus has no labelled pages, and for names that they lack.
WORD, TAG, HINTED = 0.5, -0.3, -0.5


def count(html: str) -> Counter:
    """(kind, name, inside) of a labelled page: one that marks its article with an element of its own."""
    found: Counter = Counter()
    for piece in pieces(html):
        if piece.hinted:  # scored by HINTED
            continue
        inside = piece.main > 0
        if piece.tag:
            found["tag", piece.tag.lstrip("/"), inside and piece.tag.lstrip("/") not in MAIN] += 1
        elif piece.context:
            found["word", piece.context, inside] += len(piece.text.split())
    return found


def fit(pages: DataFrame) -> Weights:
    """Log-odds of words and tags inside the article element against outside, over labelled pages.

    Labelled pages are those with an article element; LABELLED of them, those of least hash, are
    enough for two dozen numbers (copies of a chosen page count as often as they occur). Words stay positive, words in links and tags negative.
    """
    ship_package(pages.sparkSession)
    labelled = pages.where(F.col("html").rlike(r"(?i)<article[\s>]")).select(
        "html", hash60(F.col("url"), F.md5("html")).alias("h")
    )
    # The hashes are chosen among narrow rows and broadcast: LABELLED rows at most, however many pages there are.
    chosen = stage(labelled.select("h").distinct().orderBy("h").limit(LABELLED), "labelled-pages")
    sample = labelled.join(F.broadcast(chosen), "h").select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                total.update(count(page))
        keys = sorted(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([k[2] for k in keys], pa.bool_()), pa.array([total[k] for k in keys], pa.int64())],
            names=["kind", "name", "inside", "n"],
        )

    counted = sample.mapInArrow(run, "kind string, name string, inside boolean, n bigint")
    common = counted.where(F.col("name").isin(sorted(BLOCK | VOID | {"a", "b", "i", "em", "strong", "span", "body"})))
    rows = common.groupBy("kind", "name", "inside").agg(F.sum("n").alias("n")).collect()
    n = {(r["kind"], r["name"], r["inside"]): r["n"] for r in rows}
    odds = {
        (kind, name): math.log((n.get((kind, name, True), 0) + 1) / (n.get((kind, name, False), 0) + 1))
        for kind, name, _ in n
    }
    words = {name: min(max(x / 4, 0.1), 1.0) for (kind, name), x in odds.items() if kind == "word" and name != "a"}
    tags = {name: min(max(x / 4 - 0.5, -2.0), -0.1) for (kind, name), x in odds.items() if kind == "tag"}
    return Weights(words | {"a": -0.5}, tags)


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and last place of the contiguous run of greatest sum, the first such; (0, -1) if none is positive."""
    best, first, last, total, start = 0.0, 0, -1, 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, first, last = total, start, i
    return first, last


def extract(html: str, weights: Weights) -> str:
    """The page's main text: blocks joined by line breaks, white space inside a block as one space."""
    parts = pieces(html)
    scores = [
        weights.tags.get(p.tag.lstrip("/"), TAG) if p.tag
        else len(p.text.split()) * (HINTED if p.hinted else weights.words.get(p.context, WORD)) if p.context else 0.0
        for p in parts
    ]
    first, last = best_run(scores)
    if last < first:
        return ""
    low, high = parts[first].block, parts[last].block
    around = {p.main for p in parts[first:last + 1] if p.context and p.main}
    blocks: dict[int, list[str]] = {}
    for p in parts:
        inside = low <= p.block <= high or p.main in around
        if inside and p.text and not p.hinted:
            blocks.setdefault(p.block, []).append(p.text)
    lines = (" ".join("".join(x).split()) for _, x in sorted(blocks.items()))
    return "\n".join(line for line in lines if line)


def main_texts(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    Null and empty pages, and pages without words outside boilerplate, give an empty text; pages cut off
    at any place give what they hold up to there; repeated rows give repeated rows; an empty table none.
    """
    ship_package(pages.sparkSession)
    held = fit(pages) if weights is None else weights
    words, tags = dict(held.words), dict(held.tags)
    source = pages.select(text_of("html").alias("html"), "page_id", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Weights(words, tags)
        for batch in batches:
            texts = pa.array([extract(h, own) for h in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), texts], names=["page_id", "url", "text"])

    return source.mapInArrow(run, "page_id bigint, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
