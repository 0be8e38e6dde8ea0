"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of words and tags. Words score above zero, tags below, and
the contiguous run of tokens with the greatest sum is the content: one linear
scan finds it. What stands inside menus, adverts, forms, comments and the like
(by element, or by class, id and role) scores a little below zero, words too:
the run neither begins nor ends with it, and where it goes on across, that text
is left out. Should a page have no other text, its classes are not believed;
neither are those of a container that holds the page's content, nor words that
name a topic as well as a part on prose inside the content (``unbelieved``).

Pages are read by one forward scan (``scan``) that never goes back, so that a
page costs what it is long, however broken its markup is. An element that is
closed at once or never ends with its tag and drops nothing after it.

Weights are log odds learned from labelled pages. Labels come from pages that
mark their content with one article or main element: tokens inside are content.
They are counted in Spark on about ``LABELLED_PAGES`` of them (drawn by a hash of
page_id); tags that were not seen keep a prior. Every page is then scored on
its own, whole.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bounds of the training sample: pages, about, the characters of one, and kinds of tags.
LABELLED_PAGES, LABELLED_CHARS, TAG_KINDS = 600, 200_000, 2_000

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: What a tag's end is looked for by: its sign, or a quoted value, which may hold one.
TAG_END = re.compile(r"=\s*[\"']|>")

# fixed values: HTML and MathML element names
CONTAINERS = frozenset(
    "html head body div section nav aside header footer form article main ul ol dl table figure fieldset "
    "button select dialog details menu".split())
INLINE = frozenset(
    "a abbr acronym audio b bdi bdo big br canvas cite code data del dfn em font i img input ins kbd label mark meter "
    "noscript object output picture progress q ruby rp rt s samp small source span strike strong sub sup svg time "
    "tt u var video wbr iframe textarea template "
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace "
    "msqrt mstyle msub msubsup msup mtext munder munderover none mprescripts semantics annotation".split())
BOILERPLATE = frozenset("head nav aside footer form button select dialog menu fieldset title".split())
CONTENT = frozenset("article main".split())
#: Elements whose inside is no text of the page. The first two go on to the page's end if nothing ends them.
CODE, NO_TEXT = ("script", "style"), ("script", "style", "svg", "iframe", "textarea", "template")
ENDS = {name: re.compile(rf"</{name}(?![a-z0-9-])", re.I) for name in CODE}
NEXT = {name: re.compile(rf"<(/?){name}(?![a-z0-9-])", re.I) for name in NO_TEXT}
# fixed values: words in class, id and role that name parts beside the content
BESIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|"
    r"sidebar|nav|navbar|navigation|menu|breadcrumbs?|footer|masthead|site-header|page-header|comments?|"
    r"disqus|repl(?:y|ies)|shar(?:e|ing)|social|related|recommend\w*|newsletter|subscribe|signup|login|"
    r"search|pagination|pager|toolbar|widget|contentinfo|complementary)(?=$|[\s_-])", re.I)
# fixed values: whole names that say so even inside the content, and those of adverts and reader comments in parts
CERTAIN = re.compile(
    r"(?:^|\s)(?:banner|cookies?|consent|gdpr|notices?|alert|popup|modal|sidebar|nav|navbar|navigation|menu|"
    r"breadcrumbs?|footer|newsletter|subscribe|signup|login|pagination|pager|toolbar|widget|"
    r"ads?|ads?[_-](?!hoc)\S*|\S*[_-]ads?|(?:advert|sponsor|promo)\S*|(?:\S*[_-])?(?:comments?|disqus|replies)(?:[_-]\S*)?)"
    r"(?=$|\s)", re.I)
MARKS = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)

#: Times the words outside that a container without articles holds to be taken for a wrapper.
OUTWEIGHS = 10
#: Words from which a part inside the content is prose, unless half of them or more are links.
PROSE = 5

WORD, BESIDE_WORD, BESIDE_TAG = "word", "beside word", "beside tag"


@dataclass
class Token:
    """A tag or a stretch of text. ``key`` names what the weight is learned
    for, ``n`` counts the words of a text (1 for a tag)."""

    key: str
    n: int
    text: str | None = None
    block: bool = False
    beside: bool = False
    inside: bool = False


@dataclass
class Weights:
    """Scores of tokens: priors where nothing was learned. What stands beside
    the content keeps its prior, since it is left out whatever it scores."""

    tags: dict[str, float] = field(default_factory=dict)
    word: float = 0.8
    beside: float = -0.05
    beside_tag: float = -0.05
    #: tags without a weight: block tags end a run sooner than inline ones
    block: float = -0.3
    inline: float = -0.02
    boundary: float = -6.0

    def of(self, t: Token) -> float:
        if t.text is not None:
            return t.n * (self.beside if t.beside else self.word)
        if t.key == BESIDE_TAG:
            return self.beside_tag
        if t.key in self.tags:
            return self.tags[t.key]
        name = t.key.lstrip("/")
        if name in CONTENT or name in BOILERPLATE or t.key in ("html", "/html", "body", "/body"):
            return self.boundary
        return self.block if t.block else self.inline


@dataclass
class Held:
    """What a page, or a container that class, id or role set beside the
    content, holds outside of boilerplate elements."""

    start: int
    #: content elements around it
    around: int
    #: whether its name says so even inside the content
    certain: bool = True
    words: int = 0
    links: int = 0
    contents: int = 0
    mains: int = 0

    def less(self, before: "Held") -> "Held":
        return Held(before.start, before.around, before.certain, self.words - before.words, self.links - before.links,
                    self.contents - before.contents, self.mains - before.mains)


def unbelieved(page: Held, marked: list[Held]) -> frozenset[int]:
    """Begins of the marked containers whose names do not say what they are.

    Those that hold the content: a main element, or, with no article or main
    elsewhere, the only article, articles with most of the words, or far more
    words than are outside. And, inside the content, prose whose name is not
    certain, as a section on social matters or on a search algorithm.
    """
    return frozenset(
        h.start for h in marked
        if h.mains or h.around + h.contents == page.contents and (
            h.contents == 1 or h.words > (1 if h.contents else OUTWEIGHS) * (page.words - h.words))
        or h.around and not h.certain and h.words >= PROSE and 2 * h.links < h.words)


TEXT, OPEN, CLOSE, ALONE = "text", "open", "close", "alone"


def scan(page: str) -> Iterator[tuple[str, str, str, int]]:
    """(kind, name, body, begin): stretches of text, begin tags and end tags with
    their attributes, and elements without text (``ALONE``), in page order.

    A sign that begins no tag is text, and so is all that follows the last tag's
    end. A quoted value may hold the sign that ends a tag; where no end is found
    that way, quotes say nothing from there on. A comment that nothing ends, a
    script or a style go on to the page's end.
    """
    pos = begin = 0  # where to look on, and where text begins
    end, quotes = -1, True  # the next sign that may end a tag; each place is looked at once
    gone: set[str] = set()  # elements without text that are not begun or ended any more
    while (at := page.find("<", pos)) >= 0:
        if page.startswith("<!--", at):
            stop = page.find("-->", at + 2)
            stop = stop + 3 if stop >= 0 else len(page)
            tag = None
        else:
            if end < at and (end := page.find(">", at)) < 0:
                break
            tag = TAG.match(page, at)
            if not tag and page[at + 1:at + 2] not in ("!", "?"):
                pos = at + 1
                continue
            stop = (_tag_end(page, tag.end()) if tag and quotes else end) + 1
            if not stop:
                quotes, stop = False, end + 1
        if begin < at:
            yield TEXT, "", page[begin:at], begin
        pos = begin = stop
        if not tag:
            continue
        name, body = tag.group(2).lower(), page[tag.end():stop - 1]
        if tag.group(1) or name not in NO_TEXT:
            yield CLOSE if tag.group(1) else OPEN, name, body, at
            continue
        yield ALONE, name, "", at
        closed = body.endswith("/")
        if name in gone or closed and name not in CODE:
            continue
        if name in CODE and not closed:
            found = ENDS[name].search(page, stop)
            if not found:
                return
        else:
            found = NEXT[name].search(page, stop)
            if not found:
                gone.add(name)
            if not found or not found.group(1):
                continue
        stop = page.find(">", found.end()) + 1
        pos = begin = stop or len(page)
    if begin < len(page):
        yield TEXT, "", page[begin:], begin


def _tag_end(page: str, at: int) -> int:
    while found := TAG_END.search(page, at):
        if found.group() == ">":
            return found.start()
        at = page.find(found.group()[-1], found.end()) + 1
        if not at:
            break
    return -1


def tokens(page: str, believe: bool = True, known: frozenset[int] | None = None) -> list[Token]:
    """The tokens of a page. Elements left open end with their parent. Without
    ``believe``, classes, ids and roles say nothing, and neither do those of the
    containers that begin at ``known`` (found in the page if None)."""
    out: list[Token] = []
    # container, beside the content, a content element, boilerplate by its name
    stack: list[tuple[str, bool, bool, bool]] = []
    opened: Counter[str] = Counter()
    beside = content = boilerplate = 0
    link = False
    whole, marked, within = Held(-1, 0), [], []  # within: for each of the stack, its Held or None
    for kind, key, body, start in scan(page):
        if kind == TEXT:
            text = html_lib.unescape(body)
            n = len(text.split())
            out.append(Token(BESIDE_WORD if beside else WORD, n, text, beside=beside > 0, inside=content > 0))
            if not boilerplate:
                whole.words, whole.links = whole.words + n, whole.links + n * link
        elif kind == ALONE:
            out.append(Token(key, 1, inside=content > 0))
        elif kind == OPEN and (key in CONTAINERS or key == "title"):
            marks = MARKS.findall(body)
            named = key in BOILERPLATE or key == "header" and not content
            told = (not named and believe and bool(marks) and key not in ("html", "body") and start not in (known or ())
                    and any(BESIDE.search(v.strip("\"'")) for _, v in marks))
            aside = named or told
            out.append(Token(BESIDE_TAG if beside or aside else key, 1, block=True, inside=content > 0))
            stack.append((key, aside, key in CONTENT, named))
            opened[key] += 1
            # until it ends, less what came before it
            within.append(Held(start, content, any(a.lower() == "role" or CERTAIN.search(v.strip("\"'")) for a, v in marks),
                               whole.words, whole.links, whole.contents, whole.mains)
                          if told and known is None and not boilerplate else None)
            beside, content, boilerplate = beside + aside, content + (key in CONTENT), boilerplate + named
            link = False
            if key in CONTENT and not boilerplate:
                whole.contents, whole.mains = whole.contents + 1, whole.mains + (key == "main")
        elif key in CONTAINERS or key == "title":
            was, link = beside, False
            while opened[key]:
                top, aside, is_content, named = stack.pop()
                opened[top] -= 1
                beside, content, boilerplate = beside - aside, content - is_content, boilerplate - named
                if (held := within.pop()) is not None:
                    marked.append(whole.less(held))
                if top == key:
                    break
            out.append(Token(BESIDE_TAG if was else f"/{key}", 1, block=True, inside=content > 0))
        else:
            if key == "a":
                link = kind == OPEN
            out.append(Token(BESIDE_TAG if beside else key if kind == OPEN else f"/{key}", 1, block=key not in INLINE,
                             inside=content > 0))
    marked += [whole.less(h) for h in within if h is not None]
    found = unbelieved(whole, marked)
    return tokens(page, believe, found) if found else out


def best_run(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous run with the greatest sum above zero;
    the first of equal ones, the shortest from its end. (0, 0) if none."""
    best, run, begin, found = 0.0, 0.0, 0, (0, 0)
    for i, s in enumerate(scores):
        if run <= 0:
            run, begin = 0.0, i
        run += s
        if run > best:
            best, found = run, (begin, i + 1)
    return found


def main_text(page: str | None, weights: Weights) -> str:
    """Blocks of the best run, white space made one space, joined by a newline."""
    if not page:
        return ""
    parts = tokens(page)
    begin, end = best_run([weights.of(t) for t in parts])
    if begin == end and any(t.n and t.text is not None for t in parts):
        parts = tokens(page, believe=False)
        begin, end = best_run([weights.of(t) for t in parts])
    blocks, block = [], []
    for t in parts[begin:end]:
        if t.text is not None:
            if not t.beside:
                block.append(t.text)
        elif t.block:
            blocks.append("".join(block))
            block = []
        elif t.key == "br" and not t.beside:
            block.append(" ")
    blocks.append("".join(block))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def labelled_counts(pages: DataFrame) -> DataFrame:
    """(key, inside, outside) over pages with exactly one content element."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                parts = tokens(page)
                if sum(t.key in CONTENT for t in parts) != 1 or not any(t.inside and t.text for t in parts):
                    continue
                for t in parts:
                    (inside if t.inside else outside)[t.key] += t.n
        keys = sorted(inside | outside)
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.string()),
                                          "inside": pa.array([inside[k] for k in keys], pa.int64()),
                                          "outside": pa.array([outside[k] for k in keys], pa.int64())})

    return (pages.select("html").mapInArrow(count, "key string, inside long, outside long")
            .groupBy("key").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")))


def learned(pages: DataFrame) -> Weights:
    """Weights from a bounded sample of the labelled pages; priors if none is labelled."""
    pages = pages.where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    n = pages.count()
    share = F.conv(F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit(""))), 1, 8), 16, 10)
    sample = (pages.where(share.cast("long") <= int(min(1.0, LABELLED_PAGES / max(n, 1)) * 2 ** 32))
              .where(F.length("html") <= LABELLED_CHARS).limit(2 * LABELLED_PAGES))
    rows = labelled_counts(sample).orderBy(F.desc(F.col("inside") + F.col("outside")), "key").limit(TAG_KINDS).collect()
    w = Weights()
    total_in, total_out = sum(r.inside for r in rows), sum(r.outside for r in rows)
    if not total_in or not total_out:
        return w
    odds = {r.key: math.log((r.inside + 0.5) / (total_in + 1)) - math.log((r.outside + 0.5) / (total_out + 1))
            for r in rows}
    w.word = min(3.0, max(0.3, odds.pop(WORD, w.word)))
    odds.pop(BESIDE_WORD, None)
    odds.pop(BESIDE_TAG, None)
    # a tag inside a block says less about where content ends than a container does
    w.tags = {k: max(-1.5 if k.lstrip("/") in INLINE or k.lstrip("/") == "li" else -8.0, min(-0.05, v))
              for k, v in odds.items()}
    return w


def extracted(pages: DataFrame, weights: Weights) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page.

    Null, empty and text-free pages give an empty text. Repeated pages are rows
    of their own; null ids and urls stay null; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py(), weights) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
