"""Main text of web pages by the maximum-scoring run of tokens.

A page is a sequence of words and tags. Words score a positive weight, tags a negative one that is
learned from labelled pages (those that mark their article with an element): the log odds of the tag
standing outside, and the words that follow it there. Words in an element of a kind that stands outside
score nothing. One linear scan finds the best contiguous run; its blocks, less the elements in it that
are of such a kind, are the text. Scripts, styles, forms and other elements that hold no prose are cut
by their names.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate
from math import log
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm._common import in_arrow, pieces

WORD_WEIGHT = 0.4
LEAST_PENALTY, UNSEEN_PENALTY, ALIEN_PENALTY = 0.05, 0.5, 0.6
HINT_COUNT = 20  # pages' worth of evidence that a hint is before anything is learned of its kind
OUTSIDE = 2.0  # log odds from which a kind of element stands outside articles
KINDS = 1 << 16  # classes of kinds of tags by hash: a table of fixed size that every kind falls into

#: Elements that are one part of a page with all they hold, where they have an end tag.
RAW = frozenset("script style noscript template textarea select svg iframe object head title".split())
#: Of these the ones that without an end tag hold the rest of the page.
ENDLESS = frozenset(("script", "style"))
# A tag ends at the first > outside a quoted value; a quote that follows no = is a character like others.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[A-Za-z](?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')|=)*+(?:>|\Z)", re.S)
_NAME = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)")
_MARK = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\shidden(?=[\s>=])|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)

#: Elements that hold no prose.
CUT = RAW | frozenset("form button dialog fieldset".split())
#: Elements, and words of a class, id or role, that hint at an element outside articles.
HINTS = frozenset(
    "nav header footer aside menu ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion navbar navigation menubar breadcrumb breadcrumbs "
    "sidebar complementary contentinfo cookie cookies consent gdpr notice notices alert modal popup overlay newsletter subscribe subscription signup login search "
    "comment comments commentlist disqus reply replies respond share sharing social related recommended recommendations widget toolbar pagination pager copyright masthead".split()
)
#: First parts of class names that only say something about their element.
MODIFIERS = frozenset("has no with without is not hide show hidden js".split())
#: Elements inside a line of text; every other element ends a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that are made for prose.
PROSE = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dd dt li td".split())
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that mark the article of a labelled page.
ARTICLE = frozenset(("article", "main"))


def _marks(tag: str) -> list[str]:
    """The names in class, id, role and itemprop, without digits."""
    return [w for m in _MARK.finditer(tag) for w in re.sub(r"[0-9]+", "", (m[1] or m[2] or m[3] or "").lower()).split() if w]


def _hinted(name: str, marks: list[str]) -> bool:
    return name in HINTS or any(w in HINTS for mark in marks for parts in [re.split(r"[^a-z]+", mark)] if parts[0] not in MODIFIERS for w in parts)


@dataclass(slots=True)
class Tag:
    """A tag of a page: where it stands, its kind, and for the start of an element where that ends."""

    name: str
    end: bool
    kind: int
    hinted: bool
    cut: bool
    close: int = 0  # the part after the element's last one; 0 for what starts no element


def _class_of(kind: str) -> int:
    return crc32(kind.encode()) % KINDS


def _tag(source: str) -> Tag:
    m = _NAME.match(source)
    if not m:
        return Tag("!", False, _class_of("!"), False, False)
    name, end = m[2].lower(), bool(m[1])
    marks = [] if end else _marks(source)
    cut = not end and (name in CUT or bool(_HIDDEN.search(source)))
    return Tag(name, end, _class_of(("/" if end else "") + name + "".join(f".{w}" for w in marks[:2])), not end and _hinted(name, marks), cut)


def _parts(page: str) -> Iterator[tuple[bool, str]]:
    """(is a tag, source) of a page in order; comments, and raw elements with an end tag, are one tag each.

    A raw element that closes itself or has no end tag is a tag like others, but that scripts and styles
    then hold the rest. Once an end tag is not found it is not looked for again, so a page is read in linear time.
    """
    at, endless = 0, set()
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            yield False, page[at : m.start()]
        end, name = m.end(), _NAME.match(m[0])
        name = name[2].lower() if name and not name[1] and not m[0].endswith("/>") else ""
        if name in RAW:
            close = None if name in endless else re.compile(rf"</{name}\s*>", re.I).search(page, end)
            if close:
                end = close.end()
            else:
                endless.add(name)
                end = len(page) if name in ENDLESS else end
        yield True, page[m.start() : end]
        at = end
    if at < len(page):
        yield False, page[at:]


def _parsed(page: str) -> tuple[list[str], list[Tag | None]]:
    """The parts of a page, and of each its tag (none: text). An element without an end tag ends where
    the one around it does, or with the page."""
    sources, tags, opened, depth = [], [], [], Counter()
    for is_tag, source in _parts(page):
        tag = _tag(source) if is_tag else None
        at = len(sources)
        sources.append(source)
        tags.append(tag)
        if tag is None or tag.name == "!":
            continue
        if tag.end:
            if depth[tag.name]:
                while opened:
                    start = opened.pop()
                    depth[tags[start].name] -= 1
                    tags[start].close = at + 1
                    if tags[start].name == tag.name:
                        break
        elif tag.name in VOID or tag.name in RAW or source.endswith("/>"):
            tag.close = at + 1
        else:
            opened.append(at)
            depth[tag.name] += 1
    for start in opened:
        tags[start].close = len(sources)
    return sources, tags


def _words(sources: list[str], tags: list[Tag | None]) -> list[int]:
    """Words before each part, and in all."""
    return list(accumulate((0 if tag else len(source.split()) for source, tag in zip(sources, tags)), initial=0))


def _marked(sources: list[str], tags: list[Tag | None], before: list[int], chosen: Callable[[Tag], bool]) -> list[bool]:
    """Of each part whether it lies in a chosen element. An element that holds an article, or on a page
    without one more than half of the words, is a frame of the page and never chosen."""
    articles = list(accumulate((bool(tag) and tag.name in ARTICLE and not tag.end for tag in tags), initial=0))
    inside, until = [], 0
    for k, tag in enumerate(tags):
        if tag and k >= until and tag.close and chosen(tag) and articles[tag.close] == articles[k] and (articles[-1] or 2 * (before[tag.close] - before[k]) <= before[-1]):
            until = tag.close
        inside.append(k < until)
    return inside


def tag_counts(page: str) -> dict[int, list[int]]:
    """Of a page that marks one article: of each kind of tag how often it stands inside and outside, and
    the most words that follow one outside. Nothing of other pages."""
    sources, tags = _parsed(page)
    if sum(bool(tag) and tag.name in ARTICLE and not tag.end for tag in tags) != 1:
        return {}
    before = _words(sources, tags)
    cut = _marked(sources, tags, before, lambda tag: tag.cut)
    seen: dict[int, list[int]] = {}
    until, last = 0, None
    for k, tag in enumerate(tags):
        if tag is None:
            if last is not None and k >= until and not cut[k]:
                last[2] = max(last[2], before[k + 1] - before[k])
            continue
        if tag.name in ARTICLE and not tag.end:
            until = tag.close
        if tag.name not in ARTICLE and not cut[k]:
            last = seen.setdefault(tag.kind, [0, 0, 0])
            last[0 if k < until else 1] += 1
    return seen


def odds(counts: tuple[int, int, int], hinted: bool) -> float:
    """The log odds of a kind of tag to stand outside."""
    inside, outside, _ = counts
    return log((outside + HINT_COUNT * hinted + 0.5) / (inside + 0.5))


def penalty(counts: tuple[int, int, int], hinted: bool) -> float:
    """What a tag of a kind costs: its log odds, and the most words that followed one outside, as far as it stands there."""
    inside, outside, words = counts
    share = (outside + HINT_COUNT * hinted) / max(1, inside + outside + HINT_COUNT * hinted)
    return max(LEAST_PENALTY, odds(counts, hinted)) + WORD_WEIGHT * words * share * share


def main_text(page: str, learned: dict[int, tuple[int, int, int]]) -> str:
    """The text of the best run of tokens; "" where no run scores above zero."""
    sources, tags = _parsed(page)
    before = _words(sources, tags)
    none = (0, 0, 0)
    cut = _marked(sources, tags, before, lambda tag: tag.cut)
    alien = _marked(sources, tags, before, lambda tag: odds(learned.get(tag.kind, none), tag.hinted) >= OUTSIDE)
    best = total = 0.0
    start = low = high = until = 0
    for k, tag in enumerate(tags):
        if cut[k]:
            score = 0.0
        elif alien[k]:  # its own two tags count, whatever it holds
            score = -ALIEN_PENALTY if k >= until else 0.0
            until = max(until, tag.close if tag else 0)
        elif tag is None:
            score = WORD_WEIGHT * (before[k + 1] - before[k])
        elif tag.name in ARTICLE:
            score = 0.0
        else:
            score = -(penalty(learned.get(tag.kind, none), tag.hinted) if tag.kind in learned or tag.hinted else LEAST_PENALTY if tag.name in PROSE else UNSEEN_PENALTY)
        total += score
        if total <= 0:
            total, start = 0.0, k + 1
        elif total > best:
            best, low, high = total, start, k + 1
    blocks, line = [], []
    for k in range(low, high):
        if tags[k] is None:
            if not cut[k] and not alien[k]:
                line.append(sources[k])
        elif tags[k].name != "!" and tags[k].name not in INLINE:
            blocks.append("".join(line))
            line = []
    blocks.append("".join(line))
    return " ".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: dict[int, list[int]] = {}
        for page in batch.column("html"):
            for kind, (inside, outside, words) in tag_counts(page.as_py() or "").items():
                of = seen.setdefault(kind, [0, 0, 0])
                of[0], of[1], of[2] = of[0] + inside, of[1] + outside, max(of[2], words)
        columns = [pa.array([of[k] for of in seen.values()], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), *columns], names=["kind", "inside", "outside", "words"])


def learned_counts(pages: DataFrame, html_column: str = "html") -> dict[int, tuple[int, int, int]]:
    """By class of kinds of tags (KINDS at most), over all labelled pages: how often one stands inside
    and outside of the article, and the most words that follow one outside."""
    counts = in_arrow(pages.select(F.col(html_column).cast("string").alias("html")), _count, "kind bigint, inside bigint, outside bigint, words bigint")
    rows = counts.groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"), F.max("words").alias("words")).collect()
    return {r["kind"]: (r["inside"], r["outside"], r["words"]) for r in rows}


def _extractor(learned: dict[int, tuple[int, int, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "html"):
                texts = [main_text(page.as_py() or "", learned) for page in part.column("html")]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    return run


def extracted(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """pages -> (row: all columns of pages, text).

    Character references are decoded once; white space inside a block becomes one space and blocks
    are joined in page order by one space. Null, empty and text-free pages give an empty text.
    Without any labelled page the hints alone set kinds of tags apart. Repeated pages and columns of any name pass through unchanged.
    """
    learned = learned_counts(pages, html_column)
    held = pages.select(F.struct("*").alias("row"), F.col(html_column).cast("string").alias("html"))
    schema = T.StructType([held.schema["row"], T.StructField("text", T.StringType())]).simpleString()
    return in_arrow(held, _extractor(learned), schema[len("struct<") : -1])
