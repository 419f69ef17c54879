"""Packing documents into sequences of a fixed number of tokens (operator 7).

Documents longer than a sequence are cut into full sequences and a rest. The rests are
packed first-fit decreasing, in groups of documents chosen at random: a tournament tree
over the bins' free room finds the first bin that fits in logarithmic time. Groups have
about ``group_docs`` rests each, whatever the corpus, so they are packed side by side.

Defined results: a null text is empty and gives just the end id; a null ``doc_id`` stays
null and its row is packed like any other; repeated rows are packed as often as they come;
an empty table gives no pieces; other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.shared import row_groups, stored, table_batches, whole_text
from claimloom.llm.token_codes import CACHE_CHUNKS, ID_BYTES, codes

SEQUENCE_TOKENS = 4096
GROUP_DOCS = 8192
# texts encoded at once: of larger parts fewer chunks come again in the next
_PART_BYTES = 8_000_000

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PACKED = "row long, bin long, offset long"


class TournamentTree:
    """Free room of bins; the first bin with enough room is found from the root down.

    Each inner node holds the most room of the bins below it. Bins are numbered from 0.
    """

    def __init__(self, bins: int, capacity: int):
        self._leaves = 1
        while self._leaves < bins:
            self._leaves *= 2
        self._room = [capacity] * (2 * self._leaves)

    def put(self, size: int) -> tuple[int, int]:
        """Bin that takes the item, and the room the bin had before."""
        room = self._room
        if room[1] < size:
            raise ValueError(f"no bin has room for {size}")
        node = 1
        while node < self._leaves:
            node *= 2
            if room[node] < size:
                node += 1
        before = room[node]
        room[node] = before - size
        place = node - self._leaves
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
        return place, before


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of each item; items of equal size go in the order given."""
    tree = TournamentTree(max(1, len(sizes)), capacity)
    places: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        place, room = tree.put(sizes[i])
        places[i] = (place, capacity - room)
    return places


def _pieces(
    batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, capacity: int, cached: int
) -> Iterator[pa.RecordBatch]:
    encoder = codes("words", tokenizer, cached)
    end = np.array([end_id], dtype="<u4").tobytes()

    def rows() -> Iterator[tuple]:
        for part in row_groups(batches, 1, _PART_BYTES):
            found = encoder.encode(part.column(1).to_pylist())
            for doc_id, code in zip(part.column(0).to_pylist(), found, strict=True):
                ids = code + end
                total = len(ids) // ID_BYTES
                for start in range(0, total, capacity):
                    piece = ids[start * ID_BYTES : (start + capacity) * ID_BYTES]
                    length = len(piece) // ID_BYTES
                    yield doc_id, start, length, zlib.crc32(piece), total

    names = [c.split()[0] for c in _PIECES.split(", ")]
    yield from table_batches(rows(), pa.schema([(n, pa.int64()) for n in names]))
    # Arrow keeps what the parts took, and the worker may go on with other work
    pa.default_memory_pool().release_unused()


def cut_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    capacity: int = SEQUENCE_TOKENS,
    cached: int = CACHE_CHUNKS,
) -> DataFrame:
    """Every document's tokens in pieces of ``capacity`` and a rest, which may be full too.

    ``cached`` is how many encoded chunks a worker remembers; it changes time and memory only.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")
    )
    cut = partial(_pieces, tokenizer=tokenizer, end_id=end_id, capacity=capacity, cached=cached)
    return rows.mapInArrow(cut, _PIECES)


def _pack_group(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    ordered = group.sort_values(["length", "row"], ascending=[False, True])
    places = first_fit_decreasing(ordered["length"].tolist(), capacity)
    return pd.DataFrame(
        {
            "row": ordered["row"].to_numpy(),
            "bin": [(int(ordered["part"].iloc[0]) << 32) + b for b, _ in places],
            "offset": [o for _, o in places],
        }
    )


def pack(
    pieces: DataFrame, capacity: int = SEQUENCE_TOKENS, group_docs: int = GROUP_DOCS
) -> DataFrame:
    """Give every piece (column ``length``) its ``sequence_id`` and ``offset``.

    The pieces get numbers and are stored before that, so that the random groups are
    the same when a task is run again. A full piece is a sequence by itself.
    """
    row = F.monotonically_increasing_id()
    kept = stored(pieces.withColumn("row", row), "pieces")
    rests = kept.where(F.col("length") < capacity)
    groups = max(1, -(-rests.count() // group_docs))
    part = F.pmod(F.xxhash64("row"), F.lit(groups))

    def pack_group(group: pd.DataFrame) -> pd.DataFrame:
        return _pack_group(group, capacity)

    packed = (
        rests.select("row", "length", part.alias("part"))
        .groupBy("part")
        .applyInPandas(pack_group, _PACKED)
    )
    # full pieces are numbered above all bins of groups
    alone = (F.col("row") + F.lit(1 << 62)).alias("sequence_id")
    full = kept.where(F.col("length") >= capacity).select(
        *pieces.columns, alone, F.lit(0).cast("long").alias("offset")
    )
    others = rests.join(packed, "row").select(
        *pieces.columns, F.col("bin").alias("sequence_id"), "offset"
    )
    return full.unionByName(others)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    capacity: int = SEQUENCE_TOKENS,
    group_docs: int = GROUP_DOCS,
    cached: int = CACHE_CHUNKS,
) -> DataFrame:
    """Pieces of all documents with their place: the two steps above."""
    pieces = cut_documents(docs, tokenizer, end_id, capacity, cached)
    return pack(pieces, capacity, group_docs)
