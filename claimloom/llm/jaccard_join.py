"""Similarity self-join on n-gram sets: documents that share enough of their shingles (operator 4).

Two texts link if the Jaccard similarity of their shingle sets is at least ``percent``.

1. Texts with equal sets become one. Shingles are 64-bit hashes of word n-grams.
2. Every set gives its first shingles under one order of all shingles, so many that two
   similar sets must have one in common. Shingles that a large share of the corpus has
   come last in that order; their list is bounded, as each has at least that share.
3. The sets with a shingle form a tile, in bands by size: only sizes within the threshold are
   compared. Each set is tried with the leader of its band, so that groups of copies become
   one component. Then, between different components only, all pairs of a tile that fit are
   compared by their bitmaps: each set's shingles hashed into a bit string some times as long
   as the set (in the tiles folded to 2048 bits at most, for the pairs found there whole). Bits
   that differ bound the overlap from above, and few pairs pass that have too little.
4. What passes is decided by intersecting the sorted arrays of hashes, for both texts read
   again and whole. Documents are connected by the links found; pairs within a component are
   not listed, as they cannot change it.

A tile with a third of all sets is split: its sets are dealt out in parts by hash, and the
pairs of parts are tiles of their own, for what is not connected yet.

Defined results: words are runs without white space, lower-cased in A-Z only; a text with
fewer words than ``n`` has its whole sequence as one shingle; a null or blank text has an
empty set and links with nothing, itself being its component; a row without ``doc_id`` takes
no part and has a null component; repeated rows are each returned; rows with one ``doc_id``
and different texts count as one node; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.components import components
from claimloom.llm.shared import (
    free_name,
    row_slices,
    stored,
    table_batches,
    texts_as_bytes,
    whole_text,
)

_SIGNATURES = (
    "doc_id long, n long, set_key binary, bitmap binary, tile_bitmap binary, "
    "shingles array<long>, first int"
)
_PAIRS = "a long, b long"
_SETS = "doc long, hashes binary"
_TILE_ROWS = "shingle long, part int, doc long, size long, parts int"
TILE_WORDS = 32  # 64-bit words of a bitmap in a tile, at most
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93],
    dtype=np.uint64,
)


@dataclass(frozen=True)
class Settings:
    """``common_share`` is the share of all shingles from which a shingle counts as common
    (so there are at most 1 / share of them); ``tile_rows`` is the largest unsplit tile."""

    words: int = 4
    percent: int = 85
    common_share: float = 2e-6
    common_least: int = 16
    block_shingles: int = 2_000_000
    tile_rows: int = 4096
    filter_bits: int = 1 << 24

    def probe_length(self, n: int) -> int:
        """First shingles of a set in which a similar set that is not larger shows."""
        return n - -(-self.percent * n // 100) + 1

    def index_length(self, n: int) -> int:
        """First shingles of a set that show in a similar set that is not smaller."""
        return n - -(-2 * self.percent * n // (100 + self.percent)) + 1


# --- sets -------------------------------------------------------------------------------


class _WordHashes(dict):
    def __init__(self, limit: int = 100_000):
        super().__init__()
        self._limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self._limit:
            self[word] = value
        return value


def shingle_set(text: bytes, size: int, known: dict) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], dtype=np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    count = len(words) - size + 1
    mixed = np.zeros(count, dtype=np.uint64)
    for i in range(size):
        mixed += hashes[i : i + count] * _MULTIPLIERS[i % 4] * np.uint64(2 * (i // 4) + 1)
    mixed ^= mixed >> np.uint64(29)
    mixed *= _MULTIPLIERS[2]
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _power_of_two(least: int) -> int:
    return 1 << (least - 1).bit_length()


def _bitmap(hashes: np.ndarray) -> bytes:
    """Bits set by the hashes: four or more to each for small sets, one or two for large.

    The width is a power of two and never smaller for a larger set.
    """
    n = len(hashes)
    width = max(64, _power_of_two(n), min(_power_of_two(4 * n), 64 * TILE_WORDS))
    bits = np.zeros(width, dtype=np.uint8)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(bitmap: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) with the bits modulo a smaller width."""
    while bitmap.shape[-1] > words:
        half = bitmap.shape[-1] // 2
        bitmap = bitmap[..., :half] | bitmap[..., half:]
    return bitmap


def _sets_of(
    batches: Iterator[pa.RecordBatch], size: int
) -> Iterator[tuple[int | None, np.ndarray]]:
    known = _WordHashes()
    for batch in batches:
        for part in row_slices(batch, 1):
            texts = texts_as_bytes(part.column(1))
            for doc_id, text in zip(part.column(0).to_pylist(), texts, strict=True):
                yield doc_id, shingle_set(text, size, known)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


# --- common shingles --------------------------------------------------------------------


def _frequent(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("shingle", pa.int64()), ("n", pa.int64()), ("total", pa.int64())])
    # what is common in the corpus is as common in some block
    least = max(2, int(2 * settings.common_share * settings.block_shingles))

    def rows() -> Iterator[tuple]:
        kept: list[np.ndarray] = []
        size = 0

        def count() -> Iterator[tuple]:
            if kept:
                found, times = np.unique(np.concatenate(kept), return_counts=True)
                often = times >= least
                pairs = zip(
                    found[often].view(np.int64).tolist(), times[often].tolist(), strict=True
                )
                yield from ((s, n, 0) for s, n in pairs)
                yield 0, 0, size

        for _, hashes in _sets_of(batches, settings.words):
            kept.append(hashes)
            size += len(hashes)
            if size >= settings.block_shingles:
                yield from count()
                kept, size = [], 0
        yield from count()

    yield from table_batches(rows(), schema)


def common_shingles(docs: DataFrame, settings: Settings) -> dict[int, int]:
    """Shingles that a large share of all have, and how many: at most 1 / share of them.

    They only come last in the order of shingles; any order gives the same links.
    """
    counts = _rows(docs).mapInArrow(
        partial(_frequent, settings=settings), "shingle long, n long, total long"
    )
    sums = stored(
        counts.groupBy("shingle").agg(F.sum("n").alias("n"), F.sum("total").alias("total")),
        "counts",
    )
    total = sums.agg(F.sum("total")).first()[0] or 0
    least = max(settings.common_least, int(settings.common_share * total))
    return {r.shingle: r.n for r in sums.where(F.col("n") >= least).collect()}


# --- signatures -------------------------------------------------------------------------


def _signatures(
    batches: Iterator[pa.RecordBatch], common, settings: Settings
) -> Iterator[pa.RecordBatch]:
    last = common.value
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("set_key", pa.binary())]
        + [("bitmap", pa.binary()), ("tile_bitmap", pa.binary())]
        + [("shingles", pa.list_(pa.int64())), ("first", pa.int32())]
    )

    def rows() -> Iterator[tuple]:
        for doc_id, hashes in _sets_of(batches, settings.words):
            n = len(hashes)
            if not n:
                yield doc_id, 0, None, None, None, None, None
                continue
            order = hashes
            if len(last):
                at = np.minimum(np.searchsorted(last, hashes), len(last) - 1)
                is_common = last[at] == hashes
                order = np.concatenate([hashes[~is_common], hashes[is_common]])
            first = order[: settings.probe_length(n)].view(np.int64)
            key = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
            bitmap = _bitmap(hashes)
            small = _folded(_as_words(bitmap), TILE_WORDS).tobytes()
            yield doc_id, n, key, bitmap, small, first, settings.index_length(n)

    yield from table_batches(rows(), schema, 1000)


def signatures(docs: DataFrame, common: dict[int, int], settings: Settings) -> DataFrame:
    """Size, key, bitmap and first shingles of every document's set."""
    spark = docs.sparkSession
    last = np.sort(np.array(list(common), dtype=np.int64).view(np.uint64))
    sent = spark.sparkContext.broadcast(last)
    return _rows(docs).mapInArrow(
        partial(_signatures, common=sent, settings=settings), _SIGNATURES
    )


def distinct_sets(signed: DataFrame) -> DataFrame:
    """One row per distinct set, under the smallest ``doc_id`` that has it."""
    # equal keys have equal values
    same = ["n", "bitmap", "tile_bitmap", "shingles", "first"]
    return (
        signed.where("set_key is not null and doc_id is not null")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("doc"), *[F.any_value(c).alias(c) for c in same])
    )


# --- tiles ------------------------------------------------------------------------------


def tile_parts(
    rows: DataFrame, common: dict[int, int], settings: Settings
) -> list[tuple[int, int]]:
    """Shingles whose tiles are split, and into how many parts: by the sets in the tile.

    Documents that hold a shingle are more than that, as copies have one set and most sets
    do not have it among their first.
    """
    many = [(s,) for s, n in common.items() if n > settings.tile_rows]
    if not many:
        return []
    listed = rows.sparkSession.createDataFrame(many, "shingle long")
    counts = (
        rows.join(F.broadcast(listed), "shingle", "left_semi")
        .groupBy("shingle")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > settings.tile_rows)
    )
    return [(r.shingle, -(-r.n // settings.tile_rows)) for r in counts.collect()]


def tile_rows(sets: DataFrame, common: dict[int, int], settings: Settings) -> DataFrame:
    """A row per set and first shingle. ``size`` is twice the set's size, plus one where the
    shingle is among those that a similar set that is not smaller must have."""
    rows = sets.select("doc", "n", "first", F.posexplode("shingles").alias("place", "shingle"))
    size = F.col("n") * 2 + (F.col("place") < F.col("first")).cast("long")
    rows = rows.select("shingle", "doc", size.alias("size"))
    split = tile_parts(rows, common, settings)
    # at most 1 / common_share rows
    parts = sets.sparkSession.createDataFrame(split, "shingle long, parts int")
    return rows.join(F.broadcast(parts), "shingle", "left").select(
        "shingle",
        F.coalesce("parts", F.lit(1)).cast("int").alias("parts"),
        F.pmod(F.xxhash64("doc"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"),
        "doc",
        "size",
    )


def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of tiles with two sets or more; rows come sorted by tile.

    A set alone in its part of a split tile stays: others are in the other parts. The last
    row of a batch is held back until its successor is known.
    """
    held: pa.RecordBatch | None = None
    held_joined = False  # whether the held row is in one tile with the row before it
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            table = pa.Table.from_batches([held, batch.cast(held.schema)])
            batch = table.combine_chunks().to_batches()[0]
        shingle, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        same = (shingle[1:] == shingle[:-1]) & (part[1:] == part[:-1])
        joined = np.append(held_joined, same)
        keep = joined | np.append(same, False) | (batch.column(4).to_numpy() > 1)
        held, held_joined = batch.slice(batch.num_rows - 1), bool(joined[-1])
        yield batch.slice(0, batch.num_rows - 1).filter(pa.array(keep[:-1]))
    if held is not None and (held_joined or held.column(4)[0].as_py() > 1):
        yield held


def shared_rows(rows: DataFrame) -> DataFrame:
    """Rows of tiles with two sets or more."""
    ordered = (
        rows.select("shingle", "part", "doc", "size", "parts")
        .repartition("shingle", "part")
        .sortWithinPartitions("shingle", "part")
    )
    return ordered.mapInArrow(_shared_rows, _TILE_ROWS)


def _led(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Each set of a tile with its leader; rows come sorted by tile and rank.

    A tile's first set is a leader, and so is each set whose size fits none of the leaders
    before it.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs() -> Iterator[tuple[int, int]]:
        tile, leaders = None, []
        for batch in batches:
            columns = (c.to_pylist() for c in batch.columns[:4])
            for shingle, part, doc, size in zip(*columns, strict=True):
                n = size >> 1
                if tile != (shingle, part):
                    tile, leaders = (shingle, part), [(doc, n)]
                    continue
                for leader, m in leaders:
                    if 100 * min(n, m) >= percent * max(n, m):
                        if leader != doc:
                            yield (leader, doc) if leader < doc else (doc, leader)
                        break
                else:
                    leaders.append((doc, n))

    yield from table_batches(pairs(), schema)


def leader_pairs(shared: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Sets and their leaders, if their bitmaps allow a link; the sizes do.

    Sets are ranked by the share of their first shingles that others have too. Of a group of
    copies that differ from one text here and there, the text itself shares most, so it
    leads in nearly all tiles of the group and the copies close to it meet it.
    """
    ranks = shared.groupBy("doc").agg((F.count("*") / F.max("size")).alias("rank"))
    ordered = (
        shared.join(ranks, "doc")
        .select("shingle", "part", "doc", "size", "rank")
        .repartition("shingle", "part")
        .sortWithinPartitions("shingle", "part", F.desc("rank"), "doc")
    )
    pairs = ordered.mapInArrow(partial(_led, percent=settings.percent), _PAIRS).distinct()
    return bits_allow(pairs, sets, settings)


def _enough_bits(a: np.ndarray, b: np.ndarray, n_a, n_b, percent: int) -> np.ndarray:
    """Whether the overlap can be large enough, going by the bits that differ.

    Each differing bit stands for at least one shingle that only one of the sets has.
    """
    apart = np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)
    most = (n_a + n_b - apart) // 2  # upper bound of the overlap
    return 100 * most >= percent * (n_a + n_b - most)


def _as_words(bitmap: bytes) -> np.ndarray:
    return np.frombuffer(bitmap, dtype="<u8")


def _passing(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs with sizes and bitmaps whose bits allow a link."""
    for batch in batches:
        a, b, n_a, n_b, bits_a, bits_b = (c.to_pylist() for c in batch.columns)
        keep = []
        for i in range(len(a)):
            x, y = _as_words(bits_a[i]), _as_words(bits_b[i])
            words = min(len(x), len(y))
            keep.append(
                bool(_enough_bits(_folded(x, words), _folded(y, words), n_a[i], n_b[i], percent))
            )
        yield batch.select(["a", "b"]).filter(pa.array(keep, type=pa.bool_()))


def bits_allow(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs that the whole bitmaps of both sets allow."""
    bits = sets.select("doc", "n", "bitmap")
    of_a = bits.toDF("a", "n_a", "bits_a")
    of_b = bits.toDF("b", "n_b", "bits_b")
    joined = pairs.join(of_a, "a").join(of_b, "b")
    return joined.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(
        partial(_passing, percent=settings.percent), _PAIRS
    )


def _tile_pairs(
    docs: np.ndarray, sizes: np.ndarray, groups: np.ndarray, bitmaps: list[bytes], percent: int
) -> Iterator[tuple[int, int]]:
    """Pairs of one tile, between components, that sizes, places and bits allow."""
    n, first = sizes >> 1, (sizes & 1).astype(bool)
    order = np.lexsort((docs, n))
    docs, n, first, groups = docs[order], n[order], first[order], groups[order]
    bits = [_as_words(bitmaps[i]) for i in order.tolist()]
    widths = np.array([len(x) for x in bits])
    folded: dict[tuple[int, int], np.ndarray] = {}
    starts = {int(w): int(np.searchsorted(widths, w)) for w in np.unique(widths)}
    ends = np.searchsorted(n, 100 * n // percent, side="right")
    for i in np.flatnonzero(first).tolist():
        lo, hi = i + 1, int(ends[i])
        if lo >= hi:
            continue
        width = int(widths[i])
        found = np.zeros(hi - lo, dtype=bool)
        for w, start in starts.items():  # sets of a size up to 1 / threshold: two widths
            a = max(lo, start)
            b = min(hi, int(np.searchsorted(widths, w, side="right")))
            if w < width or a >= b:
                continue
            if (w, width) not in folded:
                stop = int(np.searchsorted(widths, w, side="right"))
                folded[w, width] = _folded(np.stack(bits[start:stop]), width)
            others = folded[w, width][a - start : b - start]
            found[a - lo : b - lo] = _enough_bits(bits[i], others, n[i], n[a:b], percent)
        found &= groups[lo:hi] != groups[i]
        for j in np.flatnonzero(found).tolist():
            if docs[i] != docs[lo + j]:
                x, y = int(docs[i]), int(docs[lo + j])
                yield (x, y) if x < y else (y, x)


def _all_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows of whole tiles, sorted by tile: ``shingle, s, t, doc, size, group, bitmap``."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def rows() -> Iterator[tuple[int, int]]:
        key, kept = None, []

        def tile() -> Iterator[tuple[int, int]]:
            if len(kept) > 1:
                docs, sizes, groups = (
                    np.array(c, dtype=np.int64) for c in list(zip(*kept, strict=True))[:3]
                )
                if (groups != groups[0]).any():
                    yield from _tile_pairs(
                        docs, sizes, groups, [k[3] for k in kept], percent
                    )

        for batch in batches:
            for shingle, s, t, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (shingle, s, t):
                    yield from tile()
                    key, kept = (shingle, s, t), []
                kept.append(row)
        yield from tile()

    yield from table_batches(rows(), schema)


def mixed_tiles(shared: DataFrame, known: DataFrame, settings: Settings) -> DataFrame:
    """Rows of all tiles that have two components: ``shingle, s, t, doc, size, group``.

    A tile is dealt out into as many parts as its own rows ask for, whatever its shingle, and
    each pair of parts ``s, t`` is a task's work: some twice ``tile_rows`` sets at most.
    """
    group = F.coalesce("component", "doc").alias("group")
    rows = shared.join(known.withColumnRenamed("node", "doc"), "doc", "left").select(
        "shingle", "part", "parts", "doc", "size", group
    )
    mixed = (
        rows.groupBy("shingle")
        .agg(
            F.min("group").alias("low"),
            F.max("group").alias("high"),
            F.count("*").alias("n"),
            F.max("parts").alias("parts"),
        )
        # the pair of a tile of two has been tried, unless it lies in two parts
        .where("low < high and (n > 2 or parts > 1)")
        .select("shingle", F.ceil(F.col("n") / settings.tile_rows).alias("split"))
    )
    # a set meets the sets of its own part and those of every other part
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("split") - 1))
    own = F.pmod(F.xxhash64("doc"), F.col("split"))
    return rows.join(mixed, "shingle").select(
        "shingle", "doc", "size", "group", own.alias("p"), others.alias("o")
    ).select(
        "shingle",
        F.least("p", "o").alias("s"),
        F.greatest("p", "o").alias("t"),
        "doc",
        "size",
        "group",
    )


def remaining_pairs(
    shared: DataFrame, sets: DataFrame, known: DataFrame, settings: Settings
) -> DataFrame:
    """Pairs between components that may link: from every tile that has two components."""
    tiles = (
        mixed_tiles(shared, known, settings)
        .join(sets.select("doc", "tile_bitmap"), "doc")
        .select("shingle", "s", "t", "doc", "size", "group", "tile_bitmap")
        .repartition("shingle", "s", "t")
        .sortWithinPartitions("shingle", "s", "t")
    )
    pairs = tiles.mapInArrow(partial(_all_pairs, percent=settings.percent), _PAIRS).distinct()
    return bits_allow(pairs, sets, settings)


# --- exact check ------------------------------------------------------------------------


def _wanted_bits(ids: DataFrame, bits: int) -> np.ndarray:
    """Bits of the hashes of the ids: a filter of fixed size that passes at least these."""
    place = F.pmod(F.xxhash64("doc"), F.lit(bits))
    words = (
        ids.select((place / 64).cast("long").alias("word"), (place % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    )
    out = np.zeros(bits // 64, dtype=np.int64)
    for row in words.collect():  # at most bits / 64 rows
        out[row.word] = row.bits
    return out


def _sets(
    batches: Iterator[pa.RecordBatch], size: int, wanted
) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc", pa.int64()), ("hashes", pa.binary())])
    filter_bits = wanted.value.view(np.uint64)

    def chosen() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(2).to_numpy()
            words = filter_bits[place >> 6]
            keep = (words >> (place & 63).astype(np.uint64)) & np.uint64(1)
            yield batch.select([0, 1]).filter(pa.array(keep.astype(bool)))

    rows = ((doc, hashes.tobytes()) for doc, hashes in _sets_of(chosen(), size))
    yield from table_batches(rows, schema, 500)


def _links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        keep = [
            similar(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent) for x, y in hashes
        ]
        yield batch.select(["a", "b"]).filter(pa.array(keep, type=pa.bool_()))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact test, on sorted arrays of distinct hashes."""
    if not len(a) or not len(b):
        return False
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(long, short), len(long) - 1)
    common = int((long[at] == short).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def linked(docs: DataFrame, pairs: DataFrame, settings: Settings) -> DataFrame:
    """The pairs ``a, b`` that link, by the sets of their whole texts."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    sent = docs.sparkSession.sparkContext.broadcast(_wanted_bits(ids, settings.filter_bits))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(settings.filter_bits)).alias("place")
    rows = _rows(docs).where(F.col("doc_id").isNotNull()).select("doc_id", "text", place)
    sets = rows.mapInArrow(partial(_sets, size=settings.words, wanted=sent), _SETS)
    sets = stored(sets.join(ids, "doc", "left_semi"), "sets")
    of_a, of_b = sets.toDF("a", "hashes_a"), sets.toDF("b", "hashes_b")
    joined = pairs.join(of_a, "a").join(of_b, "b")
    return joined.select("a", "b", "hashes_a", "hashes_b").mapInArrow(
        partial(_links, percent=settings.percent), _PAIRS
    )


# --- the join ---------------------------------------------------------------------------


def _known(edges: DataFrame) -> DataFrame:
    return stored(components(edges), "components")


def group_similar(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    common = common_shingles(docs, settings)
    signed = stored(signatures(docs, common, settings), "signatures")
    sets = stored(distinct_sets(signed), "distinct-sets")
    rows = tile_rows(sets, common, settings)
    shared = stored(shared_rows(rows), "tiles")

    pairs = stored(leader_pairs(shared, sets, settings), "pairs")
    links = stored(linked(docs, pairs, settings), "links")
    known = _known(links)
    more = stored(remaining_pairs(shared, sets, known, settings), "pairs")
    more_links = stored(linked(docs, more, settings), "links")
    if not more_links.isEmpty():
        stars = known.select(F.col("node").alias("a"), F.col("component").alias("b"))
        known = _known(stars.unionByName(more_links))

    found = sets.select("set_key", "doc").join(
        known.withColumnRenamed("node", "doc"), "doc", "left"
    )
    found = found.select("set_key", F.coalesce("component", "doc").alias("component"))
    rows = signed.select("doc_id", "n", "set_key").join(found, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with one row of each group of similar texts, the one that names the group.

    Rows without ``doc_id`` stay. Columns and their order stay.
    """
    grouped = group_similar(docs, settings)
    name = free_name(docs.columns, "dropped_id")
    dropped = (
        grouped.where(F.col("doc_id") != F.col("component_id"))
        .select(F.col("doc_id").alias(name))
        .distinct()
    )
    kept = docs.join(dropped, F.col("doc_id").cast("long") == F.col(name), "left_anti")
    return kept.select(*docs.columns)
