"""Main text of web pages by equivalence classes of tokens (operator 2).

Pages of a host come from a template. Its tokens are tags with their path, and texts;
tokens that occur equally often on each page of the host share their occurrence vector and form
a class. Vectors are compared by sums of hashes, added up page by page, so a host with a third
of all pages is merged in every task before the shuffle and no vector is ever built. A class
counts if it is on enough pages, on more than two that differ, and has tags; of its texts
count those that nest in the path of one of its tags. All such classes make the template, nested
by their paths. On a page, a token that stands once counts where it is in the class's order;
the slots between the template's tokens hold what differs from page to page. Of what the slots
hold, that below the article (by tag, or else the slot with most text) is the main text, without
blocks that menus, forms, adverts and the like hold. A text that the template would take nearly
all of is an article that many pages have, and stays.
Marks of elements around the article do not hold inside it, unless articles without such marks
hold more text. Forms and names (whole classes, ids and roles) mark by degrees: where nothing
unmarked is left, what has the fewest marks is taken.

Defined results: a null html is empty and has an empty text; a null ``page_id`` or ``url``
stays; pages without a host share one; repeated rows are each returned, and pages with the same
tags and texts count as one page where a class needs different ones; elements nested deeper than
``DEEPEST`` share a path; an empty table gives no rows; other columns are not read, whatever
their names.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.shared import row_slices, stored, table_batches
from claimloom.operators.sizing import fits_broadcast, spread_join

# Fixed values.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li "
    "main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
# Elements that end an open one before them without its end tag.
ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "tr": ("tr", "td", "th"),
}
RAW = frozenset("script style noscript template textarea iframe svg math title".split())
MAIN = frozenset(("article", "main"))
LEFT_OUT = frozenset("nav aside footer menu dialog button select head".split())
LEFT_OUT_NAMES = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "cookie cookies disqus footer menu modal nav navbar navigation newsletter notice "
    "popup promo related respond share sharing sidebar social sponsor sponsored "
    "subscribe toolbar widget".split()
)

# A quotation mark opens a value only behind an equals sign; elsewhere it is a character.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>",
    re.S,
)
_BARE_VALUE = re.compile(r"=\s*[^\s\"'>]+\Z")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_SPACE = re.compile(r"\s+")
_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"

SUPPORT = 0.5
OWN_SHARE = 0.25  # less of an article than this is left only where it is no template's
DEEPEST = 256
_DEEP = "~"
_PAGE_BITS = 62
_VECTOR_BITS = 31

_TOKENS = (
    "host string, token long, path string, is_text boolean, vector long, vector2 long, "
    "differing long, pages long, times long, chars long, place long"
)
_TEXTS = "page_id long, url string, text string"


@dataclass
class _Element:
    name: str
    path: str
    out: bool  # in a part that is left out
    main: str  # path of the main element it is in, or ""
    marks: int = 0  # forms and elements with a name that is left out, around it
    named: bool = False  # whether one of these has such a name
    wrapped: bool = False  # whether the main element is in a part that is left out


@dataclass
class Block:
    text: str
    path: str
    out: bool
    main: str
    place: int  # in the order of the page's tags and blocks
    marks: int
    wrapped: bool


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    tags: dict[str, int] = field(default_factory=dict)
    places: dict[str, int] = field(default_factory=dict)  # where a tag stands first
    length: int = 0

    def next_place(self) -> int:
        self.length += 1
        return self.length


def _names(attributes: str) -> list[str]:
    found = " ".join("".join(m) for m in _NAMES.findall(attributes)).lower()
    return found.replace("/", "_").split()  # paths are split at "/"


def read_page(source: str) -> Page:
    """Tags with their paths and counts, and the text blocks in page order."""
    page = Page()
    stack = [_Element("", "", False, "")]
    parts: list[str] = []

    def finish() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            top = stack[-1]
            place = page.next_place()
            page.blocks.append(
                Block(text, top.path, top.out, top.main, place, top.marks, top.wrapped)
            )

    def close(name: str) -> None:
        """End the innermost element of that name, but not from inside an article."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name == name:
                if name in BLOCKS or any(e.name in BLOCKS for e in stack[i:]):
                    finish()
                del stack[i:]
                return
            if stack[i].name in MAIN and name not in ("body", "html"):
                return

    def end_implied(name: str) -> None:
        """A block ends an open paragraph; some also end open elements of their kind."""
        ended = {"p", *ENDS.get(name, ())}
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in ended:
                del stack[i:]
            elif stack[i].name in BLOCKS:
                return

    at, end = 0, len(source)
    while at < end:
        tag = _TAG.search(source, at)
        if tag is None:
            rest = source[at:]
            cut = re.search(r"<[A-Za-z/!?]", rest)  # a tag that the page's end cuts off
            parts.append(rest[: cut.start()] if cut else rest)
            break
        parts.append(source[at : tag.start()])
        at = tag.end()
        closing, name, attributes = tag[1], tag[2], tag[3]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
            continue
        if closing:
            close(name)
            continue
        if name in BLOCKS:
            finish()
            end_implied(name)
        above = stack[-1]
        own = _names(attributes) if attributes else []
        label = name + "".join("." + n for n in own[:4])
        if len(stack) <= DEEPEST:
            path = f"{above.path}/{label}"
        else:
            path = above.path if above.path.endswith(_DEEP) else f"{above.path}/{_DEEP}"
        page.tags[path] = page.tags.get(path, 0) + 1
        page.places.setdefault(path, page.next_place())
        if name in VOID or (attributes.endswith("/") and not _BARE_VALUE.search(attributes)):
            continue
        if name in RAW:
            # what is inside is no markup, and no text of the page
            stop = re.compile(rf"</{name}\s*>", re.I).search(source, at)
            at = stop.end() if stop else end
            continue
        if name in MAIN and not above.main:
            wrapped = name == "article" and (above.out or above.named)
            stack.append(_Element(name, path, False, path, wrapped=wrapped))
            continue
        out = above.out or name in LEFT_OUT or (name == "header" and not above.main)
        named = name not in ("html", "body", *MAIN) and not LEFT_OUT_NAMES.isdisjoint(own)
        marks = above.marks + (named or name == "form")
        stack.append(
            _Element(name, path, out, above.main, marks, above.named or named, above.wrapped)
        )
    finish()
    return page


def _text_token(block: Block) -> int:
    return xxhash.xxh3_64_intdigest(f"{block.path}\0{block.text}") >> 1


def _least_marks(blocks: list[Block]) -> int:
    return min((b.marks for b in blocks if not b.out), default=0)


def _tag_token(path: str) -> int:
    return xxhash.xxh3_64_intdigest(path) >> 1


def _page_tokens(page: Page) -> Iterator[tuple[int, str, bool, int, int, int]]:
    """Token, path, whether it is a text, times on the page, characters below the path, place."""
    chars: dict[str, int] = {}
    texts: dict[int, tuple[str, int, int]] = {}
    least = _least_marks(page.blocks)
    for block in page.blocks:
        chars[block.path] = chars.get(block.path, 0) + (
            0 if block.out or block.marks > least else len(block.text)
        )
        token = _text_token(block)
        _, times, place = texts.get(token, ("", 0, block.place))
        texts[token] = (block.path, times + 1, place)
    # a path comes after the one around it, so backwards all below it has been added up
    for path in reversed(page.tags):
        around = path.rpartition("/")[0]
        chars[around] = chars.get(around, 0) + chars.get(path, 0)
    for path, times in page.tags.items():
        yield _tag_token(path), path, False, times, chars.get(path, 0), page.places[path]
    for token, (path, times, place) in texts.items():
        yield token, path, True, times, 0, place


def _content_bit(tokens: list[tuple]) -> int:
    """One bit by what the page holds: pages with other bits have other tags or texts."""
    held = ",".join(f"{token}x{times}" for token, _, _, times, *_ in tokens)
    return 1 << xxhash.xxh3_64_intdigest(held) % _PAGE_BITS


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("host", pa.string()), ("token", pa.int64()), ("path", pa.string())]
        + [("is_text", pa.bool_())]
        + [
            (c, pa.int64())
            for c in ("vector", "vector2", "differing", "pages", "times", "chars", "place")
        ]
    )
    found: dict[tuple[str, int], list] = {}
    low = (1 << _VECTOR_BITS) - 1

    def rows() -> Iterator[tuple]:
        for (host, token), row in found.items():
            yield host, token, *row
        found.clear()

    for batch in batches:
        for part in row_slices(batch, 1):
            for host, source, number in zip(*(c.to_pylist() for c in part.columns), strict=True):
                tokens = list(_page_tokens(read_page(source)))
                content = _content_bit(tokens)
                for token, path, is_text, times, *sums in tokens:
                    seen = xxhash.xxh3_64_intdigest(f"{number} {times}")
                    row = found.setdefault((host, token), [path, is_text, 0, 0, 0, 0, 0, 0, 0])
                    row[2] += seen & low
                    row[3] += (seen >> _VECTOR_BITS) & low
                    row[4] |= content
                    row[5] += 1
                    row[6] += times
                    row[7] += sums[0]
                    row[8] += sums[1]
            if len(found) > 50_000:
                yield from table_batches(rows(), schema)
    yield from table_batches(rows(), schema)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def _rows(pages: DataFrame) -> DataFrame:
    """One row per page; the number names a page in the occurrence vectors."""
    source = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        host_of(F.col("url").cast("string")).alias("host"),
        source.alias("html"),
    )


def equivalence_classes(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Tokens on enough pages of their host, with the class they are in.

    A class is named by sums of hashes of the occurrence vector. The share of pages keeps what a
    few pages have in common out of the template; ``differing`` has a bit for each different
    page, as long as they are few, and keeps out what only copies of one page have.
    """
    number = F.xxhash64("page_id", "url").alias("number")
    tokens = (
        rows.select("host", "html", number)
        .mapInArrow(_tokens, _TOKENS)
        .groupBy("host", "token")
        .agg(
            F.min("path").alias("path"),
            F.max("is_text").alias("is_text"),
            F.sum("vector").alias("vector"),
            F.sum("vector2").alias("vector2"),
            F.bit_or("differing").alias("differing"),
            F.sum("pages").alias("pages"),
            F.sum("times").alias("times"),
            F.sum("chars").alias("chars"),
            F.sum("place").alias("place"),
        )
    )
    hosts = rows.groupBy("host").agg(F.count("*").alias("host_pages"))
    return tokens.join(hosts, "host").where(F.col("pages") >= support * F.col("host_pages"))


def templates(classes: DataFrame) -> DataFrame:
    """One row per host: ``tokens`` of the template with their ``groups``, and ``slot``, the
    path of the template element that holds most text.

    A class is what has one occurrence vector, on more than two different pages. It needs a tag
    and a text, and its texts must lie in the path of one of its tags; what lies around such a
    tag is on these pages too, so that all classes nest. Tokens that stand once on their pages
    come in the order of their class, which is their group; others have none. Of the elements
    once per page the slot is the deepest with over half of the host's text.
    """
    alike = ["host", "vector", "vector2", "pages", "times"]
    tag = F.when(~F.col("is_text"), F.col("path"))
    valid = (
        classes.where("bit_count(differing) > 2")
        .groupBy(*alike)
        .agg(F.collect_set(tag).alias("tags"), F.max("is_text").alias("has_text"))
        .where(F.col("has_text") & (F.size("tags") > 0))
    )
    nests = F.exists(
        "tags", lambda t: (F.col("path") == t) | F.col("path").startswith(F.concat(t, F.lit("/")))
    )
    # all of a class are on the same pages, so their sums of places are in its order
    group = F.when(F.col("times") == F.col("pages"), F.col("vector"))
    member = F.struct("place", "token", group.alias("group"))
    members = (
        classes.join(valid, alike)
        .where(~F.col("is_text") | nests)
        .groupBy("host")
        .agg(F.array_sort(F.collect_list(member)).alias("members"))
        .withColumns({"tokens": F.col("members.token"), "groups": F.col("members.group")})
        .drop("members")
    )
    once = classes.where("not is_text and times = pages")
    all_chars = once.groupBy("host").agg(F.max("chars").alias("most"))
    slots = (
        once.join(all_chars, "host")
        .where("most > 0 and chars * 2 > most")
        .groupBy("host")
        .agg(F.max_by("path", F.struct(F.length("path"), "path")).alias("slot"))
    )
    return (
        classes.select("host")
        .distinct()
        .join(members, "host", "left")
        .join(slots, "host", "left")
        .withColumnRenamed("host", "template_host")
    )


def longest_rising(values: list[int]) -> list[int]:
    """Places of a longest rising part of the values, which are distinct."""
    lasts: list[int] = []  # least last value of a rising part, by its length
    at: list[int] = []
    before: list[int] = []
    for i, value in enumerate(values):
        n = bisect_left(lasts, value)
        lasts[n : n + 1] = [value]
        at[n : n + 1] = [i]
        before.append(at[n - 1] if n else -1)
    found, i = [], at[-1] if at else -1
    while i >= 0:
        found.append(i)
        i = before[i]
    return found[::-1]


def template_blocks(page: Page, tokens: list[int], groups: list[int | None]) -> set[int]:
    """Numbers of the blocks that are the template's: texts in the order of their class."""
    ranks = {token: rank for rank, token in enumerate(tokens)}
    cut: set[int] = set()
    seen: dict[int, list[tuple[int, int, int]]] = {}
    for number, block in enumerate(page.blocks):
        rank = ranks.get(_text_token(block)) if ranks else None
        if rank is None:
            continue
        if groups[rank] is None:
            cut.add(number)
        else:
            seen.setdefault(groups[rank], []).append((block.place, rank, number))
    for path, place in page.places.items() if seen else ():
        rank = ranks.get(_tag_token(path))
        if rank is not None and groups[rank] in seen:
            seen[groups[rank]].append((place, rank, -1))
    for events in seen.values():
        events.sort()
        cut.update(events[i][2] for i in longest_rising([rank for _, rank, _ in events]))
    return cut - {-1}


def _chars(blocks: list[Block]) -> int:
    return sum(len(b.text) for b in blocks)


def main_blocks(page: Page, cut: set[int], slot: str) -> list[str]:
    """What the template leaves: below the article, or else in the template's largest slot.

    What the template holds and is yet nearly all of the article, or of the page's text below
    the slot, is an article that many pages have, and stays.
    """
    left = _main_blocks(page, cut, slot)
    if cut:
        whole = _main_blocks(page, set(), slot)
        held = [b for b in whole if b.main]
        # outside an article menus and notices may well be most of the text
        share = OWN_SHARE if held else 0
        if not left or _chars(left) < share * _chars(whole):
            left = whole
    return [b.text for b in left]


def _main_blocks(page: Page, cut: set[int], slot: str) -> list[Block]:
    left = [b for i, b in enumerate(page.blocks) if i not in cut and not b.out]
    # an article whose own texts are all the template's has no others
    least = _least_marks([b for b in page.blocks if b.main])
    main = [b for b in left if b.main and b.marks == least]
    free = [b for b in main if not b.wrapped]
    if _chars(free) * 2 >= _chars(main):
        main = free
    if main:
        return main
    rest = [b for b in left if not b.main]
    least = _least_marks(rest)
    rest = [b for b in rest if b.marks == least]
    below = [b for b in rest if slot and (b.path == slot or b.path.startswith(slot + "/"))]
    return below or rest


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in row_slices(batch, 2):
            page_id, url, *read = part.columns
            found = []
            for source, tokens, groups, slot in zip(*(c.to_pylist() for c in read), strict=True):
                page = read_page(source)
                cut = template_blocks(page, tokens or [], groups or [])
                found.append("\n\n".join(main_blocks(page, cut, slot or "")))
            columns = [page_id, url, pa.array(found, type=pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])


def extract_text(pages: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, from its whole html."""
    rows = _rows(pages)
    # read several times, and small: what most pages of a host have in common
    classes = stored(equivalence_classes(rows, support), "token-classes")
    template = stored(templates(classes), "templates")
    template = template.withColumnRenamed("template_host", "host")
    if fits_broadcast(template):
        joined = rows.join(F.broadcast(template), "host", "left")
    else:
        # a host with a third of all pages is dealt out to many tasks
        joined = spread_join(rows, template, ["host"], "left", spread_by=["page_id", "url"])
    return (
        joined.select("page_id", "url", "html", "tokens", "groups", "slot")
        .mapInArrow(_extract, _TEXTS)
        .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
    )
