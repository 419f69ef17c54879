"""Runs of periodically repeated words, and texts without the repeats (operator 11).

A run is a stretch of words whose smallest period is q, at least four periods and six words
long, that no word beside it extends with that period. The periods are taken in octaves, from
2**k to below 2**(k+1). For each octave a text is exploded into tiles whose length goes
with the period and which overlap by half, so that any four periods lie whole in some tile.
A tile is solved by itself: at boundaries three shortest periods apart, Z-functions to both
sides tell how far each period of the octave reaches. The fragments found are shuffled by
text and period and stitched where they overlap by a period, which restores each run.

Two exact tests keep work small. A word inside a run comes again within the period, so tiles
are only made where all words do so for three periods on end; and a stretch that has a
shorter period throughout holds no run of this octave. Equal texts are solved once. Tiles,
not texts, are dealt out, so a very long document is solved by many tasks.

Defined results: words are the parts between blanks, tabs, line and page breaks (ASCII
only); a null text is empty and has no words or runs; repeated rows and equal texts get the
same result each; other columns are kept, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.shared import row_slices, stored, table_batches, texts_as_bytes, whole_text

PERIODS = 4
MIN_WORDS = 6

Fragment = tuple[int, int, int]  # period, start, end

_TILES = "digest string, octave int, start long, words binary"
_FRAGMENTS = "digest string, period long, start long, end long"
_RUN = "struct<start:bigint,length:bigint,period:bigint>"
_COLLAPSED = f"digest string, runs array<{_RUN}>, collapsed string"


# --- one text ---------------------------------------------------------------------------


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8; ``bytes`` are split at ASCII white space only."""
    return text.split()


def word_numbers(words: Iterable[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], dtype="<i4")


def _next_distances(ids: np.ndarray) -> np.ndarray:
    """How far ahead each word comes again; for the last of its kind more than any distance."""
    order = np.argsort(ids, kind="stable")
    same = ids[order[1:]] == ids[order[:-1]]
    near = np.full(len(ids), 2 * len(ids) + 2)
    near[order[:-1][same]] = np.diff(order)[same]
    return near


def tile_places(ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """Octave and start of each tile in which a run may have four periods of the octave."""
    n, octave = len(ids), 0
    if n < PERIODS:
        return
    near = _next_distances(ids)
    breaks = np.arange(n)
    while PERIODS << octave <= n:
        shortest = 1 << octave
        breaks = breaks[near[breaks] >= 2 * shortest]
        edges = np.concatenate(([-1], breaks, [n]))
        long = np.flatnonzero(np.diff(edges) > (PERIODS - 1) * shortest)
        found: set[int] = set()
        for start, end in zip((edges[long] + 1).tolist(), edges[long + 1].tolist(), strict=True):
            period = int(near[start:end].max())
            if period < shortest and np.array_equal(
                ids[start:end], ids[start + period : end + period]
            ):
                continue  # all of it has a shorter period
            found.update(_tiles_over(start, min(n, end + 2 * shortest), shortest))
        for start in sorted(found):
            yield octave, start
        octave += 1


def _tile_step(shortest: int) -> int:
    """Half a tile: room for four of the longest periods of the octave."""
    return PERIODS * 2 * shortest


def _tiles_over(start: int, end: int, shortest: int) -> list[int]:
    """Tiles that share four shortest periods or more with a stretch."""
    step, need = _tile_step(shortest), PERIODS * shortest
    first = max(0, -(-(start + need - 2 * step) // step))
    return [t * step for t in range(first, (end - need) // step + 1)]


def z_function(s: list[int], most: int) -> list[int]:
    """For the first ``most`` places: how much of ``s`` from there equals its beginning."""
    n = len(s)
    found = [0] * min(n, most)
    if found:
        found[0] = n
    low = high = 0
    for i in range(1, len(found)):
        k = min(high - i, found[i - low]) if i < high else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > high:
            low, high = i, i + k
        found[i] = k
    return found


@lru_cache(maxsize=1 << 14)
def _shorter(period: int) -> tuple[int, ...]:
    """The period divided by each of its prime factors."""
    found, rest, factor = [], period, 2
    while factor * factor <= rest:
        if rest % factor == 0:
            found.append(period // factor)
            while rest % factor == 0:
                rest //= factor
        factor += 1
    if rest > 1:
        found.append(period // rest)
    return tuple(found)


def solve_tile(ids: np.ndarray, octave: int) -> set[Fragment]:
    """Each stretch of four periods or more within a tile, for the octave's smallest periods."""
    n, shortest = len(ids), 1 << octave
    numbers = ids.tolist()
    found: set[Fragment] = set()
    for place in range(0, n - shortest, (PERIODS - 1) * shortest):
        ahead = np.flatnonzero(ids[place + shortest : place + 2 * shortest] == ids[place])
        if not len(ahead):
            continue
        right = z_function(numbers[place:], 2 * shortest)
        # what ends at the boundary, reversed, sought in all that ends up to 2 periods later
        top = min(n, place + 2 * shortest)
        before = numbers[:place][::-1]
        joined = [*before, -1, *numbers[:top][::-1]]
        left = z_function(joined, place + 1 + top - place - shortest + 1)
        for period in (ahead + shortest).tolist():
            start = place - left[place + 1 + top - place - period]
            end = place + period + right[period]
            if end - start >= PERIODS * period and not any(
                np.array_equal(ids[start : start + period], ids[start + d : start + d + period])
                for d in _shorter(period)
            ):
                found.add((period, start, end))
    return found


def without_repeats(words: list[bytes], runs: Iterable[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run (start, length, period) holds after its first period."""
    runs = list(runs)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return [words[i] for i in np.flatnonzero(kept).tolist()]


# --- tables -----------------------------------------------------------------------------


def text_digest(words: list[bytes]) -> str:
    """sha256 of the words joined by one space."""
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in row_slices(batch, 1):
            digests, texts = [], []
            for text in texts_as_bytes(part.column(1)):
                words = words_of(text)
                digests.append(text_digest(words))
                some = next(tile_places(word_numbers(words)), None)
                texts.append(None if some is None else b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(digests, type=pa.string()),
                    pa.array(texts, type=pa.binary()).cast(pa.string()),
                ],
                names=["row", "digest", "text"],
            )


def mark(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns as the struct ``row``, the digest, and the text if it has tiles."""
    rows = docs.select(F.struct(*keep).alias("row"), whole_text(text).alias("text"))
    schema = T.StructType(
        [rows.schema["row"], T.StructField("digest", T.StringType()), rows.schema["text"]]
    )
    schema["text"].nullable = True
    return rows.mapInArrow(_marked, schema)


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for digest, text in zip(
                batch.column(0).to_pylist(), texts_as_bytes(batch.column(1)), strict=True
            ):
                ids = word_numbers(words_of(text))
                for octave, start in tile_places(ids):
                    end = start + 2 * _tile_step(1 << octave)
                    yield digest, octave, start, ids[start:end].tobytes()

    names = [("digest", pa.string()), ("octave", pa.int32()), ("start", pa.int64())]
    yield from table_batches(rows(), pa.schema([*names, ("words", pa.binary())]), 2_000)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            columns = (c.to_pylist() for c in batch.columns)
            for digest, octave, place, words in zip(*columns, strict=True):
                fragments = solve_tile(np.frombuffer(words, dtype="<i4"), octave)
                for period, start, end in fragments:
                    yield digest, period, place + start, place + end

    numbers = [(c, pa.int64()) for c in ("period", "start", "end")]
    yield from table_batches(rows(), pa.schema([("digest", pa.string()), *numbers]))


def stitched(fragments: DataFrame) -> DataFrame:
    """Fragments of one text and period that overlap by a period or more, made one run each."""
    by = ["digest", "period"]
    ordered = Window.partitionBy(*by).orderBy("start", "end")
    reach = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("start") > reach - F.col("period"), F.lit(True))
    pieces = fragments.distinct().withColumn("apart", apart.cast("long"))
    number = F.sum("apart").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    length = F.max("end") - F.min("start")
    return (
        pieces.withColumn("number", number)
        .groupBy(*by, "number")
        .agg(F.min("start").alias("start"), length.alias("length"))
        .where((F.col("length") >= MIN_WORDS) & (F.col("length") >= PERIODS * F.col("period")))
        .select("digest", "start", "length", "period")
    )


def find_runs(texts: DataFrame) -> DataFrame:
    """All runs (``digest, start, length, period``) of distinct texts (``digest, text``)."""
    tiles = texts.select("digest", "text").mapInArrow(_exploded, _TILES)
    # a number, as tiles are small for the time they take: Spark would merge partitions
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiles.repartition(tasks, F.xxhash64("digest", "octave", "start"))
    return stitched(dealt.mapInArrow(_solved, _FRAGMENTS))


def _collapse(batches: Iterator[pa.RecordBatch], type_: pa.DataType) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("digest", pa.string()), ("runs", type_), ("collapsed", pa.string())])

    def rows() -> Iterator[tuple]:
        for batch in batches:
            texts = texts_as_bytes(batch.column(2))
            both = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True)
            for digest, runs, text in both:
                places = ((r["start"], r["length"], r["period"]) for r in runs)
                kept = without_repeats(words_of(text), places)
                yield digest, runs, b" ".join(kept).decode()

    yield from table_batches(rows(), schema, 2_000)


def collapsed_texts(marked: DataFrame) -> DataFrame:
    """Each distinct text that has runs: ``digest, runs, collapsed``; runs by start, period."""
    texts = (
        marked.where(F.col("text").isNotNull())
        .groupBy("digest")
        .agg(F.first("text").alias("text"))
    )
    texts = stored(texts, "periodic-texts")
    run = F.struct("start", "length", "period")
    in_order = F.array_sort(
        F.collect_list(run),
        lambda a, b: F.when(_before(a, b), -1).when(_before(b, a), 1).otherwise(0),
    )
    runs = find_runs(texts).groupBy("digest").agg(in_order.alias("runs"))
    fields = pa.struct([(f, pa.int64()) for f in ("start", "length", "period")])
    collapse = partial(_collapse, type_=pa.list_(fields))
    return runs.join(texts, "digest").select("digest", "runs", "text").mapInArrow(
        collapse, _COLLAPSED
    )


def _before(a: Column, b: Column) -> Column:
    return (a["start"] < b["start"]) | (
        (a["start"] == b["start"]) & (a["period"] < b["period"])
    )


def with_runs(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Each row's ``keep`` columns as ``row``, with ``digest, runs, collapsed``.

    ``digest`` is the sha256 of the words joined by one space; ``runs`` and ``collapsed`` are
    null where the text has no runs. Both sides of the join are stored, so that Spark can
    split the partition of a text with very many rows.
    """
    marked = stored(mark(docs, keep, text), "marked-texts")
    found = stored(collapsed_texts(marked), "collapsed-texts")
    return marked.select("row", "digest").join(found, "digest", "left")


def collapse_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each run of each text cut down to its first period.

    Columns and rows stay; a text without runs stays as it is.
    """
    found = with_runs(docs, docs.columns, text)
    columns = {c: F.col("row")[c] for c in docs.columns}
    columns[text] = F.coalesce("collapsed", columns[text])
    return found.select(*[column.alias(name) for name, column in columns.items()])
