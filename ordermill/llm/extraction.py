"""Main text of HTML pages by two-pass block rules.

1. A page is cut into blocks at its block-level tags; comments, scripts, styles and the like are left out, character references
   decoded, white space made one space. A block knows its length, the share of it that is link text, its words and stop words,
   the container it stands in, and whether that container or the block is marked as something else than text: by its tag
   (nav, aside, footer, form ..), or by a word of its class, id or role (menu, sidebar, cookie, advert, comment ..).
2. First pass, each block for itself. Marked blocks and those of mostly link text are out. Long blocks with enough stop words are
   in, long ones with few are out. What is left is ambiguous: short blocks, and those with some stop words.
3. Second pass, by context. An ambiguous block takes the label of the nearest decided block of its own container, marked ones
   aside; without one, that of the nearest decided block of the page, where text must lie on both sides or, for a heading, next after it.
4. Where a page says which part is its article (article, else main), blocks elsewhere are out, and an ambiguous block of an
   article without any decided block is in: length and stop words decide about blocks, not about whether a short article counts.

Both passes work on all blocks of a batch of pages as arrays. A page is one row and is read whole; rows don't move.

Defined results: a null or empty page, and one without text, give an empty text; unclosed tags end with their parent, unclosed
scripts and comments with the page; repeated rows are extracted alike; an empty table gives an empty result; other columns
pass through, those named like an added one are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ordermill.llm.common import map_arrow, quoted, without
from ordermill.llm.words import batches as text_batches

# Common short words of four languages, tags and the words by which pages mark their parts.
STOP_WORDS = frozenset("""
the of and to in a is that for it was with are be on as by this at from or have an they which not his but had were
de la le et les des en un du une que est pour qui dans par plus pas au sur ne se il sont avec ce aux ou son leur
der die und den von zu das mit sich auf für ist im dem nicht ein eine als auch es an er so dass wie bei oder aus nach
el y los del las con no su al lo como más o pero sus le ha me si sin sobre este ya entre cuando muy
""".split())
UNREAD = "script|style|noscript|template|title|textarea|select|iframe|object|svg|math|canvas|button|audio|video"
BLOCKS = frozenset("""
address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary
table tbody td tfoot th thead tr ul
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OTHER_TAGS = frozenset("head nav aside footer form menu dialog search fieldset legend".split())
OTHER_WORDS = frozenset("""
ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar widget widgets
menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar cookie cookies consent gdpr notice notices
alert popup modal overlay newsletter subscribe signup login search comment comments commentlist reply replies respond disqus
discussion share sharing social related recommended pagination pager copyright disclaimer complementary contentinfo skip hidden
""".split())
# An open tag of the left kind ends one of its own kind, up to the parent on the right.
SIBLINGS = {
    **{name: ({"li"}, {"ul", "ol", "menu", "dir"}) for name in ("li",)},
    **{name: ({"dt", "dd"}, {"dl"}) for name in ("dt", "dd")},
    **{name: ({"td", "th"}, {"tr", "table"}) for name in ("td", "th")},
    "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"optgroup"}),
}
# A quote opens a value behind an equals sign only, so a stray one does not run on.
VALUES = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({UNREAD})\b{VALUES}>.*?(?:</\1\s*>|\Z)|<(/?)([a-z][a-z0-9:-]*)({VALUES})(?:>|\Z)|<[!?/][^>]*+>", re.S | re.I)
ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

WORD = re.compile(r"\w+")

SHORT = 70  # characters other than white space
LINKED = 0.5  # share of a block's characters
RICH, SOME = 0.30, 0.20  # share of a block's words that are stop words


@dataclass(slots=True)
class Element:
    name: str
    other: bool  # marked as no text, or inside such an element
    article: int  # 0 none, 1 main, 2 article
    container: int


@dataclass(slots=True)
class Block:
    container: int
    other: bool
    article: int
    heading: bool
    text: list[str] = field(default_factory=list)
    linked: int = 0


def marked(attributes: str) -> bool:
    """Whether a tag's class, id or role names something else than text, or the tag is hidden."""
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
        elif name in ("class", "id", "role") and any(parts[0] in OTHER_WORDS or parts[-1] in OTHER_WORDS for parts in (re.split(r"[-_]+", w.strip("-_")) for w in value.split())):
            return True
    return False


def blocks(html: str) -> list[Block]:
    """The blocks of a page in order, also those that are no text."""
    stack = [Element("", False, 0, 0)]
    out: list[Block] = []
    current: Block | None = None
    link = 0  # how deep the stack was when the link that is open began, 0 without one
    at = containers = 0

    def said(text: str) -> None:
        nonlocal current
        if not text:
            return
        text = unescape(text)
        top = stack[-1]
        if current is None:
            if text.isspace():
                return
            current = Block(top.container, top.other, top.article, top.name in HEADINGS)
            out.append(current)
        elif top.other and not current.other:
            return  # a marked part within a line of text
        current.text.append(text)
        if link:
            current.linked += len("".join(text.split()))

    for m in TOKEN.finditer(html):
        said(html[at: m.start()])
        at = m.end()
        closing, name, attributes = m[2], m[3], m[4]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            if current is not None:
                current.text.append(" ")
            continue
        is_block = name in BLOCKS
        if is_block:
            current = None
        if name in VOID:
            continue
        if closing:
            if name == "a":
                link = 0
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
                if not is_block and stack[k].name in BLOCKS:
                    break  # an inline tag does not close the block around it
        elif name == "a":
            link = len(stack)
        else:
            if is_block and stack[-1].name == "p":
                stack.pop()
            if name in SIBLINGS:
                own, parents = SIBLINGS[name]
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name in parents:
                        break
                    if stack[k].name in own:
                        del stack[k:]
                        break
            top = stack[-1]
            other = top.other or name in OTHER_TAGS or (name not in ("html", "body") and bool(attributes) and not attributes.isspace() and marked(attributes))
            if name == "header" and not top.article:
                other = True
            if is_block:
                if top.name == "header" and top.article and name not in HEADINGS:
                    other = True  # by-lines and dates
                article = top.article
                if not other and name in ("article", "main"):
                    article = max(article, 2 if name == "article" else 1)
                plain = name in ("p", "li", "dt", "dd", "option", "blockquote", "pre") or name in HEADINGS
                if not plain and not (name == "header" and article):
                    containers += 1
                    stack.append(Element(name, other, article, containers))
                else:
                    stack.append(Element(name, other, article, top.container))
            elif other and not top.other:
                stack.append(Element(name, True, top.article, top.container))
        if link > len(stack):
            link = 0
    said(html[at:])
    return out


def first_pass(length: np.ndarray, linked: np.ndarray, n_words: np.ndarray, n_stop: np.ndarray, other: np.ndarray, article: np.ndarray) -> np.ndarray:
    """1 for text, -1 for something else, 0 for ambiguous blocks."""
    density = n_stop / np.maximum(n_words, 1)
    label = np.zeros(len(length), np.int8)
    label[(length >= SHORT) & (density >= RICH)] = 1
    label[(length >= SHORT) & (density < SOME) & ~article] = -1
    label[other | (linked > LINKED * length)] = -1
    return label


def _nearest(label: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, ...]:
    """(label, distance) of the last decided block before and the next one after each block in its group; groups lie together."""
    n = len(label)
    at = np.arange(n)
    far = np.int64(1 << 40)
    decided = label != 0
    before = np.maximum.accumulate(np.where(decided, at, -1))
    after = np.minimum.accumulate(np.where(decided, at, n)[::-1])[::-1]
    out = []
    for k in (before, after):
        real = (k >= 0) & (k < n)
        k = np.where(real, k, at)
        real &= group[k] == group
        out += [np.where(real, label[k], 0), np.where(real, np.abs(k - at), far)]
    return tuple(out)


def second_pass(label: np.ndarray, page: np.ndarray, container: np.ndarray, heading: np.ndarray, article: np.ndarray) -> np.ndarray:
    """Whether each block is text, once ambiguous ones have taken the label of their neighbours."""
    order = np.lexsort((np.arange(len(label)), container, page))
    group = np.stack((page, container))[:, order]
    _, number = np.unique(group, axis=1, return_inverse=True)
    back = np.argsort(order)
    before, d_before, after, d_after = (x[back] for x in _nearest(label[order], number.ravel()))
    known = (before != 0) | (after != 0)
    own_side = np.where(d_before < d_after, before, np.where(d_after < d_before, after, np.maximum(before, after)))
    own_side = np.where(heading & (after != 0), after, own_side)
    before, _, after, _ = _nearest(label, page)
    page_side = np.where(heading, after, np.minimum(before, after))
    page_side = np.where(article, 1, page_side)
    return np.where(label != 0, label, np.where(known, own_side, page_side)) > 0


def labelled(pages: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(text, page and verdict) of every block of a batch of pages."""
    cut = [blocks(html) if html else [] for html in pages]
    flat = [b for page in cut for b in page]
    page = np.repeat(np.arange(len(pages)), [len(b) for b in cut])
    texts = [" ".join("".join(b.text).split()) for b in flat]
    words = [WORD.findall(t.lower()) for t in texts]
    column = lambda values, kind: np.fromiter(values, kind, len(flat))
    length = column((len(t) - t.count(" ") for t in texts), np.int64)
    other = column((b.other for b in flat), bool)
    level = np.where(other | (length == 0), 0, column((b.article for b in flat), np.int64))
    # The part that a page calls its article, if any: blocks elsewhere are not.
    best = np.zeros(len(pages), np.int64)
    np.maximum.at(best, page, level)
    article = (best[page] > 0) & (level == best[page])
    other |= (best[page] > 0) & ~article
    n_stop = column((sum(map(STOP_WORDS.__contains__, said)) for said in words), np.int64)
    label = first_pass(length, column((b.linked for b in flat), np.int64), column((len(w) for w in words), np.int64), n_stop, other, article)
    container = np.where(other, -1, column((b.container for b in flat), np.int64))
    text = second_pass(label, page, container, column((b.heading for b in flat), bool), article)
    return texts, page, text & (length > 0)


def main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without their html, with ``text`` and ``n_chars``, its code points."""
    base = without(pages, {"text", "n_chars"} - {html.lower()})
    names = [c for c in base.columns if c.lower() != html.lower()]
    rows = base.select(*[quoted(c) for c in names], quoted(html).cast("string").alias("html"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_batches(batch.column(batch.num_columns - 1), 1 << 20):
                part = batch.slice(lo, hi - lo)
                texts, page, kept = labelled(part.column(part.num_columns - 1).to_pylist())
                said: list[list[str]] = [[] for _ in range(part.num_rows)]
                for k in np.flatnonzero(kept).tolist():
                    said[page[k]].append(texts[k])
                joined = [" ".join(s) for s in said]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(joined, pa.string()), pa.array([len(t) for t in joined], pa.int64())],
                                                 names=[*names, "text", "n_chars"])

    return map_arrow(rows, run, schema)
