"""Conversations in reply order, without their quotations (operator 3).

Lines that begin with ``>`` are quotations, as many deep as there are signs. Adjacent quoted
lines of one depth make a passage, as do adjacent lines that a message says itself. Passages
are normalised and hashed whole, by sentence and by line, so that a quotation that was
wrapped anew, or quotes a message in part, is found too. Hashed quoted passages are joined
with the last earlier message of the conversation that said them. A quoted line goes if
it lies in linked passages; what links with nothing stands nowhere else, and stays. A message
replies to the message that most of its outermost linked lines come from. Replies stand under
their parent, before its later replies, and threads in the order of their beginnings.

Texts are parsed in Python, row by row; all else are joins. Linking is one grouping by
conversation and hash in the order of turns: a passage that very many messages say or quote
gives no pairs. Of what messages say, only what some quotation may have hashed is shuffled: a
filter of fixed size tells. The order of replies is the rank in a walk around their trees,
found by joins that double the distance each round, however long a chain of replies is.

Defined results: a null text is empty; a null ``conv_id`` is a conversation of its own, a null
``turn`` comes first and links with nothing; rows with one ``conv_id`` and ``turn`` share
their reply link; repeated rows are each returned; ties go to the later turn; an empty table
gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.shared import stored, table_batches, whole_text

FILTER_BITS = 1 << 24

_SIGNS = re.compile(r"[ \t]*((?:>[ \t]?)+)")
# The line before a quotation that names its writer ends like this.
_NAMED = re.compile(r"\b(wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$", re.I)
_QUOTES = r"(?:^|[\r\n])[ \t]*>"
_SENTENCE = re.compile(r"(?<=[.!?]) ")
_SPACE = re.compile(r"\s+")

_KEY = ["conv_id", "turn", "digest"]
_UNITS = "conv_id long, turn long, digest long, passage int, first int, last int, hash long"
_HASHES = "conv_id long, turn long, hash long"
_READ = (
    "conv_id long, turn long, role string, text string, n_quoted long, n_linked long, "
    "votes array<struct<depth:int,source:bigint>>"
)


# --- one message ------------------------------------------------------------------------


class Line(NamedTuple):
    depth: int  # 0 for what the message says itself
    said: str
    whole: str


class Unit(NamedTuple):
    """A part of a passage that can be looked up: the line numbers it reaches over."""

    first: int
    last: int
    text: str


def read_lines(text: str) -> list[Line]:
    found = []
    for line in re.split(r"\r\n|\r|\n", text):
        signs = _SIGNS.match(line)
        depth = signs[1].count(">") if signs else 0
        found.append(Line(depth, line[signs.end() :] if signs else line, line))
    return found


def normal(said: str) -> str:
    return _SPACE.sub(" ", said).strip().lower()


def _names_quotation(lines: list[Line], at: int) -> bool:
    """Whether a line only names who is quoted next, one level deeper than it stands."""
    deeper = at + 1 < len(lines) and lines[at + 1].depth > lines[at].depth
    return deeper and _NAMED.search(lines[at].said) is not None


def passages(lines: list[Line], quoted: bool) -> list[list[int]]:
    """Line numbers of each run of adjacent lines of one depth, blank ones and names between."""
    found: list[list[int]] = []
    for at, line in enumerate(lines):
        fits = (line.depth > 0) == quoted and normal(line.said)
        if not fits or _names_quotation(lines, at):
            continue
        last = found[-1][-1] if found else -2
        if last == at - 1 and lines[last].depth == line.depth:
            found[-1].append(at)
        else:
            found.append([at])
    return found


def units(lines: list[Line], passage: list[int]) -> list[Unit]:
    """The whole passage, then its lines, then its sentences, each once."""
    said = [normal(lines[at].said) for at in passage]
    whole = " ".join(said)
    found = [Unit(passage[0], passage[-1], whole)]
    if len(passage) > 1:
        found += [Unit(at, at, text) for at, text in zip(passage, said, strict=True)]
    sentences = _SENTENCE.split(whole)
    if len(sentences) > 1:
        ends = np.cumsum([len(s) + 1 for s in said])
        start = 0
        for sentence in sentences:
            # the lines in which its first and its last letter stand
            first, last = np.searchsorted(ends, [start, start + len(sentence) - 1], side="right")
            found.append(Unit(passage[first], passage[last], sentence))
            start += len(sentence) + 1
    return found


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) >> 1


def linked_lines(
    lines: list[Line], links: dict[tuple[int, int, int, int], int]
) -> dict[int, int]:
    """The turn that each linked line comes from.

    ``links`` gives the sources of units by passage, first and last line and hash. A line is
    linked by its passage or by itself, or if every sentence that it holds a part of is.
    """
    found: dict[int, int] = {}
    for number, passage in enumerate(passages(lines, quoted=True)):
        whole, *parts = units(lines, passage)
        source = links.get((number, whole.first, whole.last, _hash(whole.text)))
        if source is not None:
            found.update(dict.fromkeys(passage, source))
            continue
        several = len(passage) > 1
        singles = parts[: len(passage)] if several else []
        sentences = parts[len(singles) :]
        told: dict[int, list[int | None]] = {}
        for unit in sentences:
            source = links.get((number, unit.first, unit.last, _hash(unit.text)))
            for at in range(unit.first, unit.last + 1):
                told.setdefault(at, []).append(source)
        for at, sources in told.items():
            if None not in sources:
                found[at] = max(sources)
        for unit in singles:
            source = links.get((number, unit.first, unit.last, _hash(unit.text)))
            if source is not None:
                found[unit.first] = source
    return found


def own_text(lines: list[Line], linked: dict[int, int]) -> str:
    """The message without its linked quotations, and lines that only name their writers."""
    gone = set(linked)
    # backwards, as a line that names goes with the line after it
    for at in range(len(lines) - 1, -1, -1):
        if _names_quotation(lines, at) and at + 1 in gone:
            gone.add(at)
    for at, line in enumerate(lines):
        if line.depth and not normal(line.said) and (at - 1 in gone or at + 1 in gone):
            gone.add(at)
    text = "\n".join(line.whole for at, line in enumerate(lines) if at not in gone)
    return re.sub(r"\n{3,}", "\n\n", text).strip()


# --- tables -----------------------------------------------------------------------------


def _messages(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        whole_text().alias("text"),
    )
    return rows.withColumn("digest", F.xxhash64("text"))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.schema([(n, kinds[t]) for n, t in (f.split() for f in ddl.split(", "))])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _quoted_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[tuple]:
        for conv_id, turn, digest, text in _rows(batches):
            lines = read_lines(text)
            for number, passage in enumerate(passages(lines, quoted=True)):
                for unit in units(lines, passage):
                    place = number, unit.first, unit.last
                    yield conv_id, turn, digest, *place, _hash(unit.text)

    yield from table_batches(found(), _schema(_UNITS))


def _said_hashes(batches: Iterator[pa.RecordBatch], wanted) -> Iterator[pa.RecordBatch]:
    bits = wanted.value

    def found() -> Iterator[tuple]:
        for conv_id, turn, text in _rows(batches):
            lines = read_lines(text)
            own = {
                _hash(unit.text)
                for passage in passages(lines, quoted=False)
                for unit in units(lines, passage)
            }
            for value in own:
                place = value % (64 * len(bits))
                if int(bits[place >> 6]) >> (place & 63) & 1:
                    yield conv_id, turn, value

    yield from table_batches(found(), _schema(_HASHES))


def _filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bits of the hashes: a filter of fixed size that passes at least these."""
    place = F.col("hash") % bits
    words = (
        hashes.select(
            (place / 64).cast("long").alias("word"), (place % 64).cast("int").alias("bit")
        )
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    )
    out = np.zeros(bits // 64, dtype=np.int64)
    for row in words.collect():  # at most bits / 64 rows
        out[row.word] = row.bits
    return out.view(np.uint64)


def linked_units(messages: DataFrame) -> DataFrame:
    """The units of quoted passages that an earlier message said, with its turn as ``source``."""
    spark = messages.sparkSession
    placed = messages.where(F.col("turn").isNotNull())
    quoting = placed.where(F.col("text").rlike(_QUOTES)).select(*_KEY, "text")
    quoted = stored(
        quoting.mapInArrow(_quoted_units, _UNITS).distinct(), "quoted-units"
    )
    wanted = spark.sparkContext.broadcast(_filter(quoted, FILTER_BITS))
    said = (
        placed.select("conv_id", "turn", "text")
        .mapInArrow(partial(_said_hashes, wanted=wanted), _HASHES)
        .distinct()
    )
    nothing = [F.lit(None).cast(quoted.schema[c].dataType).alias(c) for c in quoted.columns[2:-1]]
    both = quoted.unionByName(said.select("conv_id", "turn", *nothing, "hash"))
    # of one turn the quotations come first, so no message quotes itself
    is_said = F.col("passage").isNull()
    earlier = (
        Window.partitionBy("conv_id", "hash")
        .orderBy("turn", is_said)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    source = F.last(F.when(is_said, F.col("turn")), ignorenulls=True).over(earlier)
    found = both.withColumn("source", source)
    return found.where("passage is not null and source is not null")


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vote = pa.struct([("depth", pa.int32()), ("source", pa.int64())])
    schema = pa.schema(
        [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string())]
        + [("text", pa.string()), ("n_quoted", pa.int64()), ("n_linked", pa.int64())]
        + [("votes", pa.list_(vote))]
    )

    def found() -> Iterator[tuple]:
        for conv_id, turn, role, text, links in _rows(batches):
            lines = read_lines(text)
            keyed = {
                (u["passage"], u["first"], u["last"], u["hash"]): u["source"] for u in links or []
            }
            linked = linked_lines(lines, keyed)
            n_quoted = sum(line.depth > 0 for line in lines)
            votes = [{"depth": lines[at].depth, "source": s} for at, s in linked.items()]
            yield conv_id, turn, role, own_text(lines, linked), n_quoted, len(linked), votes

    yield from table_batches(found(), schema, 2_000)


def without_quotations(messages: DataFrame) -> DataFrame:
    """Every message with its own text and the ``votes`` of its linked lines for a parent."""
    quotes = F.col("text").rlike(_QUOTES)
    unit = F.struct("passage", "first", "last", "hash", "source")
    links = linked_units(messages).groupBy(*_KEY).agg(F.collect_list(unit).alias("links"))
    links = links.withColumnsRenamed({k: f"of_{k}" for k in _KEY})
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in _KEY]
    quoting = messages.where(quotes).join(links, same[0] & same[1] & same[2], "left")
    assembled = quoting.select("conv_id", "turn", "role", "text", "links").mapInArrow(
        _assembled, _READ
    )
    text = F.regexp_replace(F.regexp_replace("text", r"\r\n?", "\n"), r"\n{3,}", "\n\n")
    none = F.lit(0).cast("long")
    others = messages.where(~quotes).select(
        "conv_id",
        "turn",
        "role",
        F.regexp_replace(text, r"(?U)^\s+|\s+$", "").alias("text"),
        none.alias("n_quoted"),
        none.alias("n_linked"),
        F.array().cast(assembled.schema["votes"].dataType).alias("votes"),
    )
    return assembled.unionByName(others)


def reply_links(read: DataFrame) -> DataFrame:
    """``conv_id, turn, parent``: of the outermost linked lines the message most come from."""
    votes = read.select("conv_id", "turn", F.inline("votes"))
    best = F.struct(-F.col("depth"), F.col("votes"), F.col("source"))
    return (
        votes.groupBy("conv_id", "turn", "depth", "source")
        .agg(F.count("*").alias("votes"))
        .groupBy("conv_id", "turn")
        .agg(F.max_by("source", best).alias("parent"))
    )


def _walk(links: DataFrame) -> DataFrame:
    """The way around each tree of replies: every message is entered and left once.

    ``conv_id, turn, leaves, next_turn, next_leaves, entered``; the last step has no next.
    """
    conv = F.col("conv_id").eqNullSafe(F.col("of_conv"))
    replies = links.select(F.col("conv_id").alias("of_conv"), F.col("turn").alias("of_turn"))
    roots = (
        links.select("conv_id", F.col("parent").alias("turn"))
        .distinct()
        .join(replies, conv & (F.col("turn") == F.col("of_turn")), "left_anti")
        .withColumn("parent", F.lit(None).cast("long"))
    )
    siblings = Window.partitionBy("conv_id", "parent").orderBy("turn")
    later = F.when(F.col("parent").isNotNull(), F.lead("turn").over(siblings))
    nodes = links.unionByName(roots).withColumn("later", later)
    first = links.groupBy(
        F.col("conv_id").alias("of_conv"), F.col("parent").alias("of_turn")
    ).agg(F.min("turn").alias("child"))
    nodes = nodes.join(first, conv & (F.col("turn") == F.col("of_turn")), "left")
    child, parent = F.col("child"), F.col("parent")
    enter = F.struct(
        F.lit(False).alias("leaves"),
        F.coalesce(child, F.col("turn")).alias("next_turn"),
        child.isNull().alias("next_leaves"),
        F.lit(1).cast("long").alias("entered"),
    )
    leave = F.struct(
        F.lit(True).alias("leaves"),
        F.coalesce("later", parent).alias("next_turn"),
        F.col("later").isNull().alias("next_leaves"),
        F.lit(0).cast("long").alias("entered"),
    )
    return nodes.select("conv_id", "turn", F.inline(F.array(enter, leave)))


def reply_order(links: DataFrame) -> DataFrame:
    """``conv_id, turn, thread, to_come``: the turn that began the thread, and how many of its
    messages are still to come, which falls in the order of replies.

    Each round the next step is the next one's next one, so the rounds are as many as the
    logarithm of the longest thread.
    """
    now = stored(_walk(links).withColumn("thread", F.col("turn")), "walk")
    while not now.where("next_turn is not null").isEmpty():
        ahead = now.select(
            F.col("conv_id").alias("a_conv"),
            F.col("turn").alias("a_turn"),
            F.col("leaves").alias("a_leaves"),
            F.col("next_turn").alias("a_next"),
            F.col("next_leaves").alias("a_next_leaves"),
            F.col("entered").alias("a_entered"),
            F.col("thread").alias("a_thread"),
        )
        same = F.col("conv_id").eqNullSafe(F.col("a_conv"))
        same &= F.col("next_turn") == F.col("a_turn")
        same &= F.col("next_leaves") == F.col("a_leaves")
        step = now.join(ahead, same, "left").select(
            "conv_id",
            "turn",
            "leaves",
            F.col("a_next").alias("next_turn"),
            F.col("a_next_leaves").alias("next_leaves"),
            (F.col("entered") + F.coalesce("a_entered", F.lit(0))).alias("entered"),
            F.coalesce("a_thread", "thread").alias("thread"),
        )
        now = stored(step, "walk")
    return now.where("not leaves").select(
        "conv_id", "turn", "thread", F.col("entered").alias("to_come")
    )


def in_reply_order(conversations: DataFrame) -> DataFrame:
    """Every message without its linked quotations, in reply order.

    Columns: ``conv_id, position`` (from 0), ``turn, role, text, parent_turn, thread_turn,
    n_quoted`` and ``n_linked``, the numbers of quoted lines and of those found.
    """
    read = stored(without_quotations(_messages(conversations)), "own-texts")
    links = stored(reply_links(read), "reply-links")
    order = reply_order(links)

    def found(df: DataFrame, names: list[str]) -> DataFrame:
        return df.withColumnsRenamed({"conv_id": names[0], "turn": names[1]})

    def same(names: list[str]) -> Column:
        return F.col("conv_id").eqNullSafe(F.col(names[0])) & (F.col("turn") == F.col(names[1]))

    a, b = ["l_conv", "l_turn"], ["o_conv", "o_turn"]
    rows = read.join(found(links, a), same(a), "left").join(found(order, b), same(b), "left")
    rows = rows.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.col("parent").alias("parent_turn"),
        F.coalesce("thread", "turn").alias("thread_turn"),
        "n_quoted",
        "n_linked",
        F.coalesce("to_come", F.lit(0)).alias("to_come"),
    )
    in_order = Window.partitionBy("conv_id").orderBy(
        "thread_turn", F.desc("to_come"), "turn", "role", "text"
    )
    position = (F.row_number().over(in_order) - 1).cast("long")
    return rows.select("conv_id", position.alias("position"), *rows.columns[1:-1])
