"""Byte-level BPE by a shuffle of distinct words, and its decoding (operator 6).

Texts are cut into pre-tokens (words). A task takes the documents of its partition in
blocks and numbers the distinct words of a block. The words are dealt out by hash, each
block's words of a bucket in one packed row, so equal words of all blocks meet in one task
and every distinct word of the whole corpus is encoded once. The ids go back to the blocks,
where the documents' lists of word numbers turn them into ids by position. Decoding joins the
ids with the token table, whose size is that of the vocabulary.

The lists of word numbers come from a second pass over the texts rather than from a
stored copy. A block's key is a hash of its words and documents, so a source that does not
give the same rows in the same order twice ends the job with an error.

Defined results: a null text is empty and has no ids; a null ``doc_id`` stays; repeated
rows are each returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache, partial
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.chunks import space_led_chunks
from claimloom.llm.shared import row_slices, table_batches, whole_text

# Fixed value: the pattern of the rank files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A word and signs behind it: both are pre-tokens, the first with the space before it. Letters
# and signs here are such in every version of Unicode.
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\[-`{-~]*)")

BLOCK_WORDS = 400_000
BLOCK_BYTES = 18 << 20
BUCKET_DOCS = 20_000  # whose distinct words in a bucket one worker remembers at a time
LEAST_BUCKETS, MOST_BUCKETS = 256, 1 << 16  # a bucket's number has two bytes
RUN_DOCS = 64

_WORDS = "bucket int, block long, words binary"
_CODES = "block long, bucket int, codes binary"
_PLACES = "block long, run int, doc_ids array<long>, counts array<int>, places binary"
_IDS = "doc_id long, ids binary"


@lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    return tiktoken.Encoding(
        path, pat_str=PATTERN, mergeable_ranks=_ranks(path), special_tokens={}
    )


def _packed(parts: list[bytes], width: int = 1) -> bytes:
    """Byte strings in one compressed piece: their number, lengths, and contents.

    Contents of numbers with ``width`` bytes are laid out by byte, which compresses better.
    """
    lengths = np.fromiter(map(len, parts), dtype="<u4", count=len(parts))
    data = _planes(b"".join(parts), width)
    head = len(parts).to_bytes(4, "little") + _planes(lengths.tobytes(), 4)
    return zstandard.compress(head + data, 3)


def _unpacked(data: bytes, width: int = 1) -> tuple[np.ndarray, bytes]:
    """The lengths and the joined contents of a packed piece."""
    data = zstandard.decompress(data)
    count = int.from_bytes(data[:4], "little")
    lengths = np.frombuffer(_joined(data[4 : 4 + 4 * count], 4), dtype="<u4")
    return lengths, _joined(data[4 + 4 * count :], width)


def _planes(data: bytes, width: int) -> bytes:
    if width == 1:
        return data
    return np.frombuffer(data, dtype=np.uint8).reshape(-1, width).T.tobytes()


def _joined(data: bytes, width: int) -> bytes:
    if width == 1:
        return data
    return np.frombuffer(data, dtype=np.uint8).reshape(width, -1).T.tobytes()


class _ChunkNumbers(dict):
    """The numbers of the words of each chunk; words are numbered as they first come."""

    def __init__(self, words: dict[str, int]):
        super().__init__()
        self._words = words
        self._find = regex.compile(PATTERN).findall

    def numbers(self, text: str) -> bytes:
        number = self._words.setdefault
        found = [number(w, len(self._words)) for w in self._find(text)]
        return np.array(found, dtype="<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        plain = _PLAIN.fullmatch(chunk)
        if plain:
            words = self._words
            code = words.setdefault(" " + plain[1], len(words)).to_bytes(4, "little")
            if plain[2]:
                code += words.setdefault(plain[2], len(words)).to_bytes(4, "little")
        else:
            code = self.numbers(" " + chunk)
        self[chunk] = code
        return code


class _Block:
    """Documents of one partition with the numbers of their words."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {}
        self._chunks = _ChunkNumbers(self.words)
        self._hash = hashlib.blake2b(digest_size=8)
        self.documents: list[tuple[int | None, bytes]] = []
        self.size = 0

    def add(self, doc_id: int | None, text: str, keep: bool) -> None:
        chunks = space_led_chunks(text)
        rest = map(self._chunks.__getitem__, chunks[1:])
        places = self._chunks.numbers(chunks[0]) + b"".join(rest)
        self._hash.update(f"{doc_id} {len(places)} {len(self.words)};".encode())
        self.size += len(places)
        if keep:
            self.documents.append((doc_id, places))

    def full(self) -> bool:
        many = len(self.words) >= BLOCK_WORDS or len(self._chunks) >= 2 * BLOCK_WORDS
        return many or self.size >= BLOCK_BYTES

    def key(self) -> int:
        last = next(reversed(self.words), "")
        ended = self._hash.copy()
        ended.update(last.encode())
        return int.from_bytes(ended.digest(), "little", signed=True)

    def buckets(self, count: int) -> np.ndarray:
        """The bucket of each word, in the order of their numbers."""
        hashes = map(xxhash.xxh3_64_intdigest, self.words)
        found = np.fromiter(hashes, dtype=np.uint64, count=len(self.words))
        return (found % np.uint64(count)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], keep: bool) -> Iterator[_Block]:
    block = _Block()
    for batch in batches:
        for part in row_slices(batch, 1):
            for doc_id, text in zip(
                part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True
            ):
                block.add(doc_id, text, keep)
                if block.full():
                    yield block
                    block = _Block()
    if block.size or block.documents:
        yield block


def _words(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for block in _blocks(batches, keep=False):
            key, buckets = block.key(), block.buckets(count)
            words = list(block.words)
            order = np.argsort(buckets, kind="stable")
            held, starts = np.unique(buckets[order], return_index=True)
            ends = np.append(starts[1:], len(order))
            for bucket, start, end in zip(*(x.tolist() for x in (held, starts, ends)), strict=True):
                yield bucket, key, _packed([words[i].encode() for i in order[start:end]])

    schema = pa.schema(
        [("bucket", pa.int32()), ("block", pa.int64()), ("words", pa.binary())]
    )
    yield from table_batches(rows(), schema, 1000)


def _places(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    """Documents' word numbers, in runs; run -1 holds the buckets of the block's words."""

    def rows() -> Iterator[tuple]:
        for block in _blocks(batches, keep=True):
            key = block.key()
            yield key, -1, [], [], _packed([block.buckets(count).astype("<u2").tobytes()], 2)
            for start in range(0, len(block.documents), RUN_DOCS):
                ids, places = zip(*block.documents[start : start + RUN_DOCS], strict=True)
                counts = [len(p) // 4 for p in places]
                yield key, start, list(ids), counts, _packed([b"".join(places)], 4)

    schema = pa.schema(
        [("block", pa.int64()), ("run", pa.int32()), ("doc_ids", pa.list_(pa.int64()))]
        + [("counts", pa.list_(pa.int32())), ("places", pa.binary())]
    )
    yield from table_batches(rows(), schema, 100)


def _codes(batches: Iterator[pa.RecordBatch], ranks: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket; within a bucket every distinct word is encoded once."""
    encode = _encoding(ranks).encode_ordinary

    def rows() -> Iterator[tuple]:
        known: dict[bytes, bytes] = {}
        now = None
        for batch in batches:
            for bucket, block, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now:
                    now, known = bucket, {}
                lengths, data = _unpacked(packed)
                ends = np.cumsum(lengths, dtype=np.int64).tolist()
                words = [data[a:b] for a, b in zip([0, *ends], ends)]
                for word in words:
                    if word not in known:
                        known[word] = np.array(encode(word.decode()), dtype="<u4").tobytes()
                yield block, bucket, _packed([known[w] for w in words], 4)

    schema = pa.schema(
        [("block", pa.int64()), ("bucket", pa.int32()), ("codes", pa.binary())]
    )
    yield from table_batches(rows(), schema, 1000)


def _gather(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, chosen: np.ndarray
) -> np.ndarray:
    """The chosen stretches of ``data``, one after the other."""
    sizes = lengths[chosen]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts[chosen] - (ends - sizes), sizes)
    return data[shift + np.arange(total, dtype=shift.dtype)]


def _stretches(values: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """Data, starts and lengths of byte strings, counted in items of ``width`` bytes."""
    lengths = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // width
    starts = np.cumsum(lengths) - lengths
    return np.frombuffer(b"".join(values), dtype=f"<u{width}"), starts, lengths


def _block_codes(codes: pa.Table, buckets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ids of a block's words with start and length of each, in the order of their numbers."""
    by_bucket = sorted(
        zip(codes.column("bucket").to_pylist(), codes.column("codes").to_pylist(), strict=True)
    )
    pieces = [_unpacked(packed, 4) for _, packed in by_bucket]
    counts = np.bincount(buckets)
    if [(b, len(p[0])) for (b, _), p in zip(by_bucket, pieces, strict=True)] != [
        (b, n) for b, n in enumerate(counts.tolist()) if n
    ]:
        raise ValueError("the texts changed between two passes: store them first")
    sizes = np.concatenate([np.zeros(0, dtype="<u4"), *[p[0] for p in pieces]]) // 4
    data = np.frombuffer(b"".join(p[1] for p in pieces), dtype="<u4")
    order = np.argsort(buckets, kind="stable")
    lengths, starts = np.zeros(len(buckets), np.int64), np.zeros(len(buckets), np.int64)
    lengths[order] = sizes
    starts[order] = np.cumsum(sizes, dtype=np.int64) - sizes
    return data, starts, lengths


def _reassemble(codes: pa.Table, places: pa.Table) -> pa.Table:
    """The documents of one block with their ids."""
    if not len(places):
        raise ValueError("the texts changed between two passes: store them first")
    rows = sorted(places.to_pylist(), key=lambda r: r["run"])
    buckets = np.frombuffer(_unpacked(rows[0]["places"], 2)[1], dtype="<u2").astype(np.int64)
    data, starts, lengths = _block_codes(codes, buckets)
    doc_ids: list[int | None] = []
    ids: list[bytes] = []
    for row in rows[1:]:
        chosen = np.frombuffer(_unpacked(row["places"], 4)[1], dtype="<u4")
        doc_ids.extend(row["doc_ids"])
        ends = np.cumsum(row["counts"]).tolist()
        for a, b in zip([0, *ends], ends):
            ids.append(_gather(data, starts, lengths, chosen[a:b]).tobytes())
    columns = [pa.array(doc_ids, type=pa.int64()), pa.array(ids, type=pa.binary())]
    return pa.Table.from_arrays(columns, names=["doc_id", "ids"])


def bucket_count(rows: DataFrame) -> int:
    """How many buckets the words are dealt out to, by the number of documents.

    Counting rows reads no text where they come from Parquet.
    """
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-rows.count() // BUCKET_DOCS)))


def encode(docs: DataFrame, ranks: str) -> DataFrame:
    """``doc_id, ids`` of every row; ids as little-endian 32-bit numbers.

    ``ranks`` is the path of a rank file, which every executor has.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")
    )
    count = bucket_count(rows)
    words = rows.mapInArrow(partial(_words, count=count), _WORDS)
    words = words.repartition("bucket").sortWithinPartitions("bucket")
    codes = words.mapInArrow(partial(_codes, ranks=ranks), _CODES)
    places = rows.mapInArrow(partial(_places, count=count), _PLACES)
    return (
        codes.groupBy("block")
        .cogroup(places.groupBy("block"))
        .applyInArrow(_reassemble, _IDS)
    )


def token_bytes(ranks: str) -> pa.Table:
    """The token-byte table, ordered by id; as long as the vocabulary."""
    by_id = sorted((i, b) for b, i in _ranks(ranks).items())
    ids, tokens = zip(*by_id, strict=True)
    return pa.table({"id": pa.array(ids, pa.int32()), "token": pa.array(tokens, pa.binary())})


@lru_cache(maxsize=2)
def _token_stretches(ranks: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = token_bytes(ranks)
    data, starts, lengths = _stretches(table.column("token").to_pylist(), 1)
    at = np.full(int(table.column("id")[-1].as_py()) + 1, -1, dtype=np.int64)
    size = np.zeros_like(at)
    ids = table.column("id").to_numpy()
    at[ids], size[ids] = starts, lengths
    return data, at, size


def _decode(batches: Iterator[pa.RecordBatch], ranks: str) -> Iterator[pa.RecordBatch]:
    data, starts, lengths = _token_stretches(ranks)
    for batch in batches:
        for part in row_slices(batch, 1):
            texts = []
            for ids in part.column(1).to_pylist():
                chosen = np.frombuffer(ids or b"", dtype="<u4")
                if len(chosen) and (starts[chosen] < 0).any():
                    raise ValueError("an id that the token table does not have")
                texts.append(_gather(data, starts, lengths, chosen).tobytes())
            columns = [*part.columns, pa.array(texts, type=pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """``doc_id, ids, decoded``: the ids joined with the token table, bytes in order.

    The table has one row per token of the vocabulary, so every task holds it whole.
    """
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(partial(_decode, ranks=ranks), f"{_IDS}, decoded binary")
