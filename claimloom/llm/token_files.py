"""Token ids of documents in compressed files with an index (operator 5).

A file holds, for each document, one zstandard frame of its ids, made with a dictionary
that all files share; then come the index (document, offset, number of ids) and a footer
with the dictionary's sha256. One short document is read with one look at the index and
one small read. Frames are compressed separately, the dictionary makes up for their size.

Files are written by the tasks, under names of their own, and count once their row is in
the manifest, which Spark commits: what a lost or repeated task has left is never read.

Defined results: a null text is empty and has just the end id; a null ``doc_id`` comes
first and stays null; repeated rows are written as often as they come; an empty table gives
an empty manifest; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.llm.shared import row_slices, table_batches, whole_text
from claimloom.llm.token_codes import ID_BYTES, codes
from claimloom.sources import hadoop

MAGIC = b"LOOMIDS1"
_HEAD = struct.Struct("<8sB32s")  # magic, bytes per id, sha256 of the dictionary
_FOOT = struct.Struct("<QQB32s8s")  # index offset, documents, bytes per id, sha256, magic
_ENTRY = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("offset", "<u8"), ("ids", "<u4")])

_ROWS = "doc_id long, text string"
_MANIFEST = "part int, place int, file string, n_docs long, n_tokens long, n_bytes long"
_DIGESTS = "doc_id long, start long, n_tokens long, ids_crc32 long"
_IDS = "doc_id long, start long, ids binary"


@dataclass(frozen=True)
class Settings:
    """``sample_docs`` and ``sample_ids`` bound what the dictionary is trained on: at most
    about so many documents, chosen by hash, and so many ids from a random place of each.
    ``cached`` is how many encoded chunks a worker remembers: time and memory, no results."""

    tokenizer: str
    end_id: int = 0
    id_bytes: int = 2
    level: int = 1
    file_bytes: int = 64 << 20
    dictionary_bytes: int = 32 << 10
    sample_docs: int = 2000
    sample_ids: int = 1024
    cached: int = 800_000


def arrow_uri(path: str) -> str:
    """The path as pyarrow names it: Hadoop's ``s3a`` is its ``s3``, and ``file:/`` has two more."""
    scheme, colon, rest = path.partition(":")
    if not colon:
        return path
    if rest.startswith("/") and not rest.startswith("//"):
        rest = "//" + rest
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return f"{scheme}:{rest}"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(arrow_uri(path))


@lru_cache(maxsize=8)
def _dictionary(path: str) -> tuple[bytes, bytes]:
    """The dictionary's content and sha256."""
    system, name = _opened(path)
    with system.open_input_file(name) as f:
        content = f.read()
    return content, hashlib.sha256(content).digest()


def _dictionary_data(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


def _serialised(code: bytes, end_id: int, id_bytes: int) -> bytes:
    ids = np.append(np.frombuffer(code, dtype="<u4"), end_id)
    if id_bytes == ID_BYTES:
        return ids.astype("<u4").tobytes()
    if ids.max() >> (8 * id_bytes):
        raise ValueError(f"an id does not fit {id_bytes} bytes")
    return ids.astype(f"<u{id_bytes}").tobytes()


def _encoded(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[tuple]:
    encoder = codes("bytes", settings.tokenizer, settings.cached)
    for batch in batches:
        for part in row_slices(batch, 1):
            found = encoder.encode(part.column(1).to_pylist())
            for doc_id, code in zip(part.column(0).to_pylist(), found, strict=True):
                yield doc_id, _serialised(code, settings.end_id, settings.id_bytes)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


# --- dictionary -----------------------------------------------------------------------


def _samples(
    batches: Iterator[pa.RecordBatch], settings: Settings
) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        most = settings.sample_ids * settings.id_bytes
        for _, data in _encoded(batches, settings):
            places = max(1, -(-len(data) // most))
            place = zlib.crc32(data) % places
            yield (data[place * most : (place + 1) * most],)

    yield from table_batches(rows(), pa.schema([("ids", pa.binary())]), 500)


def train_dictionary(docs: DataFrame, settings: Settings) -> bytes:
    """A dictionary for the serialized ids, from a bounded sample; empty for few documents."""
    rows = _rows(docs)
    total = rows.count()
    buckets = 1 << 30
    share = min(buckets, int(buckets * settings.sample_docs / max(total, 1)))
    sample = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)) < share)
    found = sample.mapInArrow(partial(_samples, settings=settings), "ids binary")
    # repeated rows have one hash, hence the limit
    samples = [bytes(r.ids) for r in found.limit(2 * settings.sample_docs).collect()]
    samples.sort()
    try:
        return zstandard.train_dictionary(
            settings.dictionary_bytes, samples, k=512, d=8
        ).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""  # too little to learn from


# --- writing --------------------------------------------------------------------------


class _File:
    """One file being written: frames first, then the index."""

    def __init__(self, folder: str, compressor, sha: bytes, id_bytes: int):
        self.name = f"{uuid.uuid4().hex}.ids"
        system, path = _opened(f"{folder}/{self.name}")
        self._out = system.open_output_stream(path)
        self._out.write(_HEAD.pack(MAGIC, id_bytes, sha))
        self._compressor, self._sha, self._id_bytes = compressor, sha, id_bytes
        self._index: list[tuple] = []
        self.size, self.tokens = _HEAD.size, 0

    def add(self, doc_id: int | None, data: bytes) -> None:
        n = len(data) // self._id_bytes
        self._index.append((doc_id or 0, doc_id is not None, self.size, n))
        self.size += self._out.write(self._compressor.compress(data))
        self.tokens += n

    def close(self) -> tuple[str, int, int, int]:
        index = np.array(self._index, dtype=_ENTRY).tobytes()
        foot = _FOOT.pack(self.size, len(self._index), self._id_bytes, self._sha, MAGIC)
        self._out.write(index + foot)
        self._out.close()
        size = self.size + len(index) + len(foot)
        return self.name, len(self._index), self.tokens, size


def _write(
    batches: Iterator[pa.RecordBatch], folder: str, dictionary: str, settings: Settings
) -> Iterator[pa.RecordBatch]:
    content, sha = _dictionary(dictionary)
    compressor = zstandard.ZstdCompressor(
        level=settings.level, dict_data=_dictionary_data(content)
    )
    part = TaskContext.get().partitionId()

    def rows() -> Iterator[tuple]:
        out, place = None, 0
        for doc_id, data in _encoded(batches, settings):
            out = out or _File(folder, compressor, sha, settings.id_bytes)
            out.add(doc_id, data)
            if out.size >= settings.file_bytes:
                yield part, place, *out.close()
                out, place = None, place + 1
        if out:
            yield part, place, *out.close()

    schema = pa.schema(
        [("part", pa.int32()), ("place", pa.int32()), ("file", pa.string())]
        + [(c, pa.int64()) for c in ("n_docs", "n_tokens", "n_bytes")]
    )
    yield from table_batches(rows(), schema)


def write_tokens(docs: DataFrame, folder: str, settings: Settings) -> DataFrame:
    """Encode every whole text and write it below ``folder``, in ascending ``doc_id`` order.

    The texts are dealt out by ranges of ``doc_id``, so tasks of equal size write in order
    without any of them seeing all. Returns the manifest, one row per file in that order.
    """
    # Spark knows the folder by any name it has, the tasks need the store's own
    where = hadoop.made_folder(docs.sparkSession, folder)
    content = train_dictionary(docs, settings)
    dictionary = f"{where}/dictionary"
    system, path = _opened(dictionary)
    with system.open_output_stream(path) as f:
        f.write(content)

    order = ["doc_id", F.xxhash64("text")]  # the second splits a key with very many rows
    ordered = _rows(docs).repartitionByRange(*order).sortWithinPartitions(*order)
    write = partial(_write, folder=where, dictionary=dictionary, settings=settings)
    ordered.mapInArrow(write, _MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(docs.sparkSession, folder)


# --- reading --------------------------------------------------------------------------


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files in order, each with ``start``, the number of ids in all files before it."""
    files = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("part", "place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long"))
    return files.withColumn("start", start)


def _index(f: pa.NativeFile, sha: bytes) -> tuple[np.ndarray, int, int]:
    """Index, where it begins, and the bytes per id of an open file."""
    size = f.size()
    foot = _FOOT.unpack(f.read_at(_FOOT.size, size - _FOOT.size))
    at, count, id_bytes, made_with, magic = foot
    if magic != MAGIC or made_with != sha:
        raise ValueError("not a file of token ids made with this dictionary")
    data = f.read_at(count * _ENTRY.itemsize, at)
    return np.frombuffer(data, dtype=_ENTRY), at, id_bytes


def _documents(folder: str, name: str) -> Iterator[tuple[int | None, int, bytes]]:
    """Each document of a file: id, ids before it in the file, ids as 32-bit numbers."""
    content, sha = _dictionary(f"{folder}/dictionary")
    decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary_data(content))
    system, path = _opened(f"{folder}/{name}")
    with system.open_input_file(path) as f:
        index, end, id_bytes = _index(f, sha)
        starts = np.cumsum(index["ids"], dtype=np.int64) - index["ids"]
        ends = np.append(index["offset"][1:].astype(np.int64), end)
        f.seek(_HEAD.size)
        with io.BufferedReader(f, 1 << 20) as frames:
            for entry, start, stop in zip(index, starts.tolist(), ends.tolist(), strict=True):
                data = decompressor.decompress(frames.read(stop - int(entry["offset"])))
                ids = np.frombuffer(data, dtype=f"<u{id_bytes}").astype("<u4").tobytes()
                yield int(entry["doc_id"]) if entry["known"] else None, start, ids


def _read(
    batches: Iterator[pa.RecordBatch],
    folder: str,
    row: Callable[[int | None, int, bytes], tuple],
    schema: pa.Schema,
) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for name, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for doc_id, start, ids in _documents(folder, name):
                    yield row(doc_id, base + start, ids)

    yield from table_batches(rows(), schema, 2000)


def _digest(doc_id: int | None, start: int, ids: bytes) -> tuple:
    return doc_id, start, len(ids) // ID_BYTES, zlib.crc32(ids)


def _whole(doc_id: int | None, start: int, ids: bytes) -> tuple:
    return doc_id, start, ids


def _read_files(spark: SparkSession, folder: str, row, schema: str) -> DataFrame:
    files = manifest(spark, folder).select("file", "start")
    where = hadoop.made_folder(spark, folder)
    tasks = spark.sparkContext.defaultParallelism
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    arrow = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in schema.split(", "))])
    # round robin after the window's one partition of file names
    return files.repartition(max(2, tasks)).mapInArrow(
        partial(_read, folder=where, row=row, schema=arrow), schema
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, ids`` of all documents; ids as little-endian 32-bit numbers."""
    return _read_files(spark, folder, _whole, _IDS)


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of all documents, from their files."""
    return _read_files(spark, folder, _digest, _DIGESTS)


def read_document(folder: str, name: str, doc_id: int) -> list[int] | None:
    """The ids of one document of one file: the index, then only that document's frame."""
    content, sha = _dictionary(f"{folder}/dictionary")
    system, path = _opened(f"{folder}/{name}")
    with system.open_input_file(path) as f:
        index, end, id_bytes = _index(f, sha)
        found = np.flatnonzero((index["doc_id"] == doc_id) & (index["known"] == 1))
        if not len(found):
            return None
        i = int(found[0])
        start = int(index["offset"][i])
        stop = int(index["offset"][i + 1]) if i + 1 < len(index) else end
        frame = f.read_at(stop - start, start)
    data = zstandard.ZstdDecompressor(dict_data=_dictionary_data(content)).decompress(frame)
    return np.frombuffer(data, dtype=f"<u{id_bytes}").tolist()
