"""Main text of web pages, with a host's repeated runs as boilerplate.

A page is read into blocks of text. Text of scripts, styles and the like is left out at
once; menus, headers and footers of the page and asides are told by their tag. A class, id
or role is evidence only: a name counts where all of its words are words of menus, adverts,
comments and so on, or say where such a thing stands (``main-nav``, not ``has-sidebar``);
within an article an id counts only if it names reader comments. An element told so, or a
form, stays if it holds the page's article, or most of the text where none is marked.

The host decides on the rest: the token streams of all text outside marked articles are
laid out by host as suffixes, across blocks, and suffixes that agree in ``RUN`` tokens (or
in a whole block, where that is shorter) on ``LEAST_PAGES`` pages of the host, and on
``SHARE`` of those that have such text, are repeated. Pages of equal blocks are one page
there, so that an article under several urls isn't taken for repeated. Where long runs
cover half of a block or more, the tokens that they cover are boilerplate; a block that
only quotes stays whole. A block shorter than a run goes if long runs cover all of it, or if
it is repeated as a whole at the head or tail of the page, with nothing but such blocks
before or behind it. A heading stays
if the block after it does. On hosts of fewer such pages only tags and names tell
boilerplate. That holds on every page, and what is left is its text. What a page marks as
its article or main part is protected: there repeated passages stay. Marks count as tags
only, so none is seen in comments, scripts or elements that are never article text.
Suffixes are grouped by the hash of their first ``RUN`` tokens, which stands in for sorting
them, and pre-aggregated, so a host with a third of all pages is no hot key and its
suffixes are never in one task.

Definitions. Null html is an empty page. White space is that of Unicode. Rows of equal
id, url and html are one page. The host is the part of the url between ``//`` and the
next ``/``, ``?``, ``#``; without one, a null host. Other columns play no part.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import stage

#: Tokens of a repeated run.
RUN = 12
#: Distinct pages of a host that a run repeats on at least, and their share of the host's.
LEAST_PAGES = 3
SHARE = 0.3
#: Shares of a host's runs that its number of pages is joined with.
_SALTS = 16

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)"
    r"(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*+)(?P<attributes2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"\b(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Words that name what isn't article text, where a whole class, id or role is made of them
#: and of words that say which one it is.
_NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsors "
    "sponsored promo promos promotion promoted banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar aside complementary contentinfo footer masthead cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
    "search share sharing social related recommended comment comments disqus respond replies "
    "widget widgets toolbar pagination pager".split()
)
_WHICH = frozenset(
    "main site page top bottom left right primary secondary global header post article blog "
    "entry block box area wrapper wrap container section list bar link links item items button "
    "buttons inner outer form thread mobile desktop sticky fixed policy reader readers user".split()
)
_NOISE_NAMES = frozenset("side-bar skip-link site-header page-header".split())
#: Words that name what readers wrote.
_READERS = frozenset("comment comments disqus respond replies".split())
#: Share of the page's text above which an element is no boilerplate by its name alone.
_MOST = 0.75
#: Elements whose content is never article text, and is left out at once.
_HARD = frozenset(
    "script style template noscript svg math canvas iframe object select button textarea "
    "input label audio video map head title".split()
)
#: Elements that are boilerplate, which the host's runs may learn from.
_NOISE = _HARD | frozenset("nav footer aside dialog menu".split())
#: Elements that are boilerplate unless they hold the article.
_SOFT = frozenset("form fieldset".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose content is taken up to their end tag, whatever it looks like.
_RAW = frozenset("script style textarea title noscript iframe".split())
#: Elements that end where the body or an article begins, if they lack an end tag.
_UNCLOSED = frozenset("nav head header footer aside title".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that run on within a block; all others begin or end one.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp "
    "small span strike strong sub sup time tt u var wbr img picture".split()
)
_MAIN_ROLE = re.compile(r"(?<![\w-])role\s*=\s*[\"']?\s*main(?![\w-])", re.I)
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    inside: bool
    noise: bool
    heading: bool


@dataclass
class _Region:
    """An element that is boilerplate by its name, if it doesn't hold the article."""

    name: str
    parent: int
    readers: bool
    in_article: bool
    articles: int  # open articles where it begins
    depth: int = 1
    holds_mark: bool = False
    chars: int = 0
    marked: int = 0


def _named(value: str) -> tuple[bool, bool]:
    """Whether one name is that of boilerplate, and of reader comments."""
    words = [w for w in re.split(r"[\s_-]+", value) if w and not w.isdigit()]
    if value in _NOISE_NAMES:
        return True, False
    noise = any(w in _NOISE_WORDS for w in words) and all(w in _NOISE_WORDS or w in _WHICH for w in words)
    return noise, noise and any(w in _READERS for w in words)


def _evidence(name: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """Whether class, id or role say that an element is boilerplate, or reader comments."""
    if name in ("html", "body", "main", "article") or not attributes:
        return False, False
    noise = readers = False
    for kind, a, b, c in _NAMED.findall(attributes):
        value = html.unescape(a or b or c).lower()
        kind = kind.lower()
        for one in value.split() if kind in ("class", "role") else [value.strip()]:
            told, comments = _named(one)
            if inside and not comments and (kind == "id" or name in _INLINE or name in _HEADINGS):
                continue
            if inside and comments and name in _INLINE:
                continue
            noise, readers = noise or told, readers or comments
    return noise, readers


def _closed_tags(page: str) -> set[int]:
    """Ends of the start tags that have an end tag, for elements that may lack theirs."""
    opened: dict[str, list[int]] = {}
    closed: set[int] = set()
    for tag in _TAG.finditer(page):
        name = (tag["name"] or tag["name2"] or "").lower()
        if name in _UNCLOSED:
            if not (tag["end"] or tag["end2"]):
                opened.setdefault(name, []).append(tag.end())
            elif opened.get(name):
                closed.add(opened[name].pop())
    return closed


def blocks(page: str) -> list[Block]:
    """All text of a page in order, one block after another, in time linear in its length."""
    out: list[Block] = []
    of: list[int] = []  # the innermost region of each block
    parts: list[str] = []
    article: list[str] = []  # open article elements
    regions: list[_Region] = []
    open_: list[int] = []  # open regions, and those of each name
    by_name: dict[str, list[int]] = {}
    noise, depth = "", 0  # the element that is noise and how often its name is open
    began = at = 0
    closed: set[int] | None = None
    heading = False

    def flush() -> None:
        text = "" if noise in _HARD else _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            out.append(Block(text, bool(article), bool(noise), heading))
            of.append(open_[-1] if open_ else -1)

    def leave(upto: int) -> None:
        while len(open_) > upto:
            by_name[regions[open_.pop()].name].pop()

    while True:
        tag = _TAG.search(page, at)
        parts.append(page[at : tag.start() if tag else len(page)])
        if tag is None:
            flush()
            break
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            continue
        end, attributes = tag["end"] or tag["end2"], tag["attributes"] or tag["attributes2"] or ""
        if name not in _INLINE:
            flush()
            heading = name in _HEADINGS and not end
        marks = name in ("article", "main") or "main" in attributes and bool(_MAIN_ROLE.search(attributes))
        if end:
            if noise:
                if name == noise:
                    depth -= 1
                    if not depth:
                        flush()
                        noise = ""
                continue
            if by_name.get(name):
                region = regions[by_name[name][-1]]
                region.depth -= 1
                if not region.depth:
                    flush()
                    # regions within it that lack an end tag end, too
                    leave(open_.index(by_name[name][-1]))
            if article and name == article[-1]:
                article.pop()
                while open_ and regions[open_[-1]].articles > len(article):
                    leave(len(open_) - 1)
            continue
        if name in _RAW:
            closing = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = closing.start() if closing else len(page)
        if noise:
            if name == noise:
                depth += 1
                continue
            if name not in ("body", "article", "main") or noise not in _UNCLOSED:
                continue
            if name != "body":
                closed = _closed_tags(page) if closed is None else closed
                if began in closed:
                    continue
            noise, depth = "", 0  # its end tag is missing
        void = name in _VOID or attributes.rstrip().endswith("/")
        if name in _NOISE or name == "header" and not article:
            if not void:
                noise, depth, began = name, 1, tag.end()
            continue
        told, readers = _evidence(name, attributes, bool(article))
        if (told or name in _SOFT) and not marks and not void:
            flush()
            parent = open_[-1] if open_ else -1
            regions.append(_Region(name, parent, readers, bool(article), len(article)))
            open_.append(len(regions) - 1)
            by_name.setdefault(name, []).append(len(regions) - 1)
            continue
        if by_name.get(name):
            regions[by_name[name][-1]].depth += 1
        if marks:
            if open_:
                regions[open_[-1]].holds_mark = True
            article.append(name)
    return _judged(out, of, regions)


def _judged(found: list[Block], of: list[int], regions: list[_Region]) -> list[Block]:
    """The blocks, with those of the regions that are boilerplate as noise."""
    total = marked = 0
    for block, i in zip(found, of):
        if not block.noise:
            size = len(block.text)
            total += size
            marked += size * block.inside
            if i >= 0:
                regions[i].chars += size
                regions[i].marked += size * block.inside
    for r in reversed(regions):  # those within come after those around them
        if r.parent >= 0:
            around = regions[r.parent]
            around.chars += r.chars
            around.marked += r.marked
            around.holds_mark |= r.holds_mark
    gone: list[bool] = []
    for r in regions:
        elsewhere = marked - r.marked
        if r.holds_mark:
            judged = elsewhere > 0 and (r.readers or 4 * elsewhere >= r.chars)
        elif r.readers or elsewhere and not r.in_article:
            judged = True
        else:
            judged = r.chars <= _MOST * (marked if r.in_article else total)
        gone.append(judged or r.parent >= 0 and gone[r.parent])
    for block, i in zip(found, of):
        block.noise |= i >= 0 and gone[i]
    return found


def article_text(page: str) -> str:
    """Text of what a page marks as its article."""
    return "\n".join(b.text for b in blocks(page) if b.inside and not b.noise)


def _text(value: bytes | None) -> str:
    return (value or b"").decode("utf-8", "replace")


_SUFFIX = "host string, run long"


def _hash(tokens: list[str]) -> int:
    import xxhash

    return xxhash.xxh64_intdigest("\x00".join(tokens)) - (1 << 63)


def _streams(found: list[dict]) -> list[tuple[int, list[list[str]]]]:
    """Tokens of each stretch of blocks outside articles, and its first token's number
    among all tokens of the page."""
    out: list[tuple[int, list[list[str]]]] = []
    at, open_ = 0, False
    for block in found:
        tokens = block["text"].split()
        if not block["inside"]:
            if not open_:
                out.append((at, []))
            out[-1][1].append(tokens)
        open_ = not block["inside"]
        at += len(tokens)
    return out


def _runs(stream: list[list[str]]) -> Iterator[tuple[int, int, int]]:
    """Hash, first and last token of every suffix of a stream that holds a run, and of
    every shorter block."""
    tokens = [t for block in stream for t in block]
    for i in range(len(tokens) - RUN + 1):
        yield _hash(tokens[i : i + RUN]), i, i + RUN
    at = 0
    for block in stream:
        if len(block) < RUN:
            yield _hash([*block, ""]), at, at + len(block)
        at += len(block)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes of all text outside marked articles, once per page; a null run counts the
    page."""
    for batch in batches:
        host, run = [], []
        for h, found in zip(*(batch.column(c).to_pylist() for c in ("host", "blocks"))):
            runs = {r for _, stream in _streams(found) for r, _, _ in _runs(stream)}
            host += [h] * (len(runs) + 1)
            run += [*runs, None]
        yield pa.RecordBatch.from_arrays(
            [pa.array(host, pa.string()), pa.array(run, pa.int64())], names=["host", "run"]
        )


_BLOCKS = pa.list_(
    pa.struct([("text", pa.string()), ("inside", pa.bool_()), ("noise", pa.bool_()), ("heading", pa.bool_())])
)
_READ = (
    "page_id long, url string, host string, page long, "
    "blocks array<struct<text string, inside boolean, noise boolean, heading boolean>>"
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of every page."""
    for batch in batches:
        found = [[vars(b) for b in blocks(_text(data))] for data in batch.column("data").to_pylist()]
        at = batch.schema.get_field_index("data")
        yield batch.set_column(at, "blocks", pa.array(found, _BLOCKS))


_SPANS = "host string, page long, run long, first long, last long"


def _open_tokens(found: list[dict]) -> np.ndarray:
    """Which tokens of a page the host decides on."""
    sizes = [len(b["text"].split()) for b in found]
    return np.repeat(np.array([not (b["inside"] or b["noise"]) for b in found], bool), sizes)


def _open_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes with their places that reach into blocks that the host decides on."""
    types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    for batch in batches:
        rows = []
        for h, p, found in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "blocks"))):
            opened = np.concatenate([[0], np.cumsum(_open_tokens(found))])
            rows += [
                (h, p, r, at + first, at + last)
                for at, stream in _streams(found)
                for r, first, last in _runs(stream)
                if opened[at + last] > opened[at + first]
            ]
        columns = zip(*rows) if rows else ((),) * len(types)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=["host", "page", "run", "first", "last"],
        )


_PAGE = "page_id long, url string, text string"


def _left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            "\n".join(_unique(found, spans or []))
            for found, spans in zip(*(batch.column(c).to_pylist() for c in ("blocks", "spans")))
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"],
        )


def _unique(found: list[dict], spans: list[dict]) -> list[str]:
    """What repeated runs leave of a page's blocks."""
    if not spans:
        return [b["text"] for b in found if not b["noise"]]
    tokens = [b["text"].split() for b in found]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(int)
    long, short = np.zeros(starts[-1], bool), np.zeros(starts[-1], bool)
    for span in spans:
        (long if span["last"] - span["first"] == RUN else short)[span["first"] : span["last"]] = True
    rows = [i for i, b in enumerate(found) if not b["noise"]]
    by_run, whole = [], []
    for i in rows:
        part = slice(starts[i], starts[i + 1])
        fixed = found[i]["inside"]
        share = 1 if len(tokens[i]) < RUN else 0.5
        by_run.append(not fixed and long[part].sum() >= share * len(tokens[i]))
        whole.append(not fixed and bool(short[part].all()))
    # shorter blocks go from both ends of the page, up to the first that is its own
    repeated = [r or w for r, w in zip(by_run, whole)]
    head = next((k for k, r in enumerate(repeated) if not r), len(rows))
    tail = next((k for k in range(len(rows), 0, -1) if not repeated[k - 1]), 0)
    gone = [r or w and (k < head or k >= tail) for k, (r, w) in enumerate(zip(by_run, whole))]
    for k in range(len(rows) - 2, -1, -1):
        if found[rows[k]]["heading"] and not gone[k + 1]:
            gone[k] = False
    out = []
    for k, i in enumerate(rows):
        if not gone[k]:
            out.append(found[i]["text"])
        elif not whole[k]:
            covered = long[starts[i] : starts[i + 1]]
            out.append(" ".join(t for t, c in zip(tokens[i], covered) if not c))
    return [text for text in out if text]


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    read = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.nullif(F.regexp_extract("url", r"//([^/?#]+)", 1), F.lit("")).alias("host"),
        F.xxhash64("page_id", "url", "html").alias("page"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("data"),
    )
    opened = stage(read.mapInArrow(_read, _READ), "html_blocks")
    # pages of equal blocks once; of articles only where they stand
    outside = F.transform(
        "blocks",
        lambda b: F.struct(F.when(~b["inside"], b["text"]).otherwise("").alias("text"), b["inside"].alias("inside")),
    )
    distinct = (
        opened.select("host", "blocks", F.xxhash64("blocks").alias("content"))
        .where(F.exists("blocks", lambda b: ~b["inside"]))
        .select("host", outside.alias("blocks"), "content")
        .dropDuplicates(["host", "content"])
    )
    counts = stage(
        distinct.select("host", "blocks")
        .mapInArrow(_suffixes, _SUFFIX)
        .groupBy("host", "run")
        .agg(F.count(F.lit(1)).alias("pages"))
        .where(f"run is null or pages >= {LEAST_PAGES}"),
        "html_counts",
    )
    # a large host's runs are dealt over several keys
    sizes = counts.where("run is null").select(
        F.col("host").alias("of_host"),
        F.col("pages").alias("all_pages"),
        F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"),
    )
    repeated = stage(
        counts.where("run is not null")
        .join(
            sizes,
            F.col("host").eqNullSafe(F.col("of_host"))
            & (F.pmod("run", F.lit(_SALTS)).cast("int") == F.col("salt")),
        )
        .where(F.col("pages") >= SHARE * F.col("all_pages"))
        .select("of_host", F.col("run").alias("of_run")),
        "html_repeated",
    )
    covered = (
        opened.select("host", "page", "blocks")
        .mapInArrow(_open_runs, _SPANS)
        .join(repeated, F.col("host").eqNullSafe(F.col("of_host")) & (F.col("run") == F.col("of_run")))
        .groupBy("page")
        .agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    )
    # pages on which the host has nothing to decide needn't be moved
    rows = opened.select("page_id", "url", "page", "blocks")
    is_open = F.exists("blocks", lambda b: ~(b["inside"] | b["noise"]))
    left = rows.where(is_open).join(covered, "page", "left").select("page_id", "url", "blocks", "spans")
    spans = F.lit(None).cast("array<struct<first:bigint,last:bigint>>").alias("spans")
    whole = rows.where(~is_open).select("page_id", "url", "blocks", spans)
    texts = left.mapInArrow(_left, _PAGE).union(whole.mapInArrow(_left, _PAGE))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
