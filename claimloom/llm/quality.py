"""Quality classifier: a factorisation machine over words, structure and length (operator 9).

A document is a sparse vector: its words, hashed, weighted by the root of their share of
the text; and bins of statistics of its structure (letters, signs, repeated lines and words,
lengths). The machine adds to the linear terms the product of low-rank factors of each pair of
features, computed in linear time: half of (square of the sum - sum of the squares) per factor.

It is trained on a bounded sample of labelled rows (``Settings.sample_docs``, by hash),
on the driver: the sample's size does not depend on the corpus. Scoring reads every whole
text in the tasks. Labels, language, source and ids are no inputs.

Defined results: a null text is empty and gets a score too; a null ``doc_id`` stays and is
not held out; repeated rows are each scored; without labels of both kinds every score is
the share of label 1, or 0.5 if there are none; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.shared import row_slices, texts_as_bytes, whole_text

FOLDS = 4
HELD_OUT_FOLD = 2
THRESHOLD = 0.7

_SCORED = "doc_id long, score double"
_FEATURES = "label double, places binary, weights binary"
_BINS = 12
_SIGNS = b"!?.,;:#*$%&|@=+-_/<>\"'()[]{}"


@dataclass(frozen=True)
class Settings:
    sample_docs: int = 6000
    buckets: int = 1 << 16
    factors: int = 8
    rounds: int = 12
    batch: int = 64
    rate: float = 0.05
    decay: float = 1e-5
    seed: int = 7


@dataclass(frozen=True)
class Machine:
    """Bias, weights and factors; ``constant`` stands for a machine without training."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    constant: float | None = None

    def score(self, places: np.ndarray, values: np.ndarray) -> float:
        if self.constant is not None:
            return self.constant
        scaled = self.factors[places] * values[:, None]
        pairs = 0.5 * float((scaled.sum(axis=0) ** 2 - (scaled**2).sum(axis=0)).sum())
        total = self.bias + float(self.weights[places] @ values) + pairs
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, total))))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    fold = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


# --- features -------------------------------------------------------------------------


class _WordPlaces(dict):
    """Bucket of each word; the first ones to come are remembered."""

    def __init__(self, buckets: int, limit: int = 100_000):
        super().__init__()
        self._buckets, self._limit = buckets, limit

    def __missing__(self, word: bytes) -> int:
        place = xxhash.xxh3_64_intdigest(word) % self._buckets
        if len(self) < self._limit:
            self[word] = place
        return place


def _structure(text: bytes, words: list[bytes]) -> list[float]:
    """Shares between 0 and 1, and lengths on a logarithmic scale."""
    size, count = max(1, len(text)), max(1, len(words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    signs = [text.count(bytes([s])) for s in _SIGNS]
    upper = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(text) - len(text.translate(None, b"0123456789"))
    led = sum(w[:1].isalpha() for w in words)
    ended = sum(w[-1:] in (b"!", b"?") for w in words)
    odd = sum(w[-1:] in (b"#", b"*", b"$", b"%", b"&", b"|") for w in words)
    return [
        upper / size,
        digits / size,
        sum(signs) / size,
        max(signs) / size,
        ended / count,
        odd / count,
        led / count,
        len(set(words)) / count,
        len(set(lines)) / max(1, len(lines)),
        min(1.0, math.log1p(len(text)) / 14),
        min(1.0, math.log1p(len(words)) / 12),
        min(1.0, math.log1p(len(lines)) / 8),
        min(1.0, len(text) / count / 20),
    ]


def features(text: bytes, known: _WordPlaces, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights of a text's features; places from ``buckets`` on are structure."""
    words = text.split()
    places = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
    places, counts = np.unique(places, return_counts=True)
    weights = np.sqrt(counts / max(1, len(words)))
    shares = _structure(text, words)
    bins = [i * _BINS + min(_BINS - 1, int(_bin(s))) for i, s in enumerate(shares)]
    structure = np.array(bins, dtype=np.int64) + buckets
    return (
        np.concatenate([places, structure]),
        np.concatenate([weights, np.full(len(bins), 0.5)]).astype(np.float32),
    )


def _bin(share: float) -> float:
    """Bins are finer near 0 and 1, where clean texts and junk part."""
    return _BINS * (2 / math.pi) * math.asin(math.sqrt(min(1.0, max(0.0, share))))


def _places_in_all(settings: Settings) -> int:
    return settings.buckets + _BINS * len(_structure(b"", []))


# --- training -------------------------------------------------------------------------


def _sample_features(
    batches: Iterator[pa.RecordBatch], settings: Settings
) -> Iterator[pa.RecordBatch]:
    known = _WordPlaces(settings.buckets)
    for batch in batches:
        found = [features(t, known, settings.buckets) for t in texts_as_bytes(batch.column(1))]
        columns = [
            batch.column(0),
            pa.array([p.astype("<u4").tobytes() for p, _ in found], type=pa.binary()),
            pa.array([w.astype("<f4").tobytes() for _, w in found], type=pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["label", "places", "weights"])


def labelled_sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """``label, places, weights`` of the sample: rows not held out, at most about
    ``sample_docs`` of them. Repeated labels are averaged; null labels and ids do not count."""
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    )
    scale = 1 << 30
    share = min(scale, int(scale * settings.sample_docs / max(usable.count(), 1)))
    chosen = usable.where(F.pmod(F.xxhash64("label_id"), F.lit(scale)) < share)
    # at most 2 * sample_docs rows of two numbers are broadcast
    chosen = F.broadcast(chosen.limit(2 * settings.sample_docs))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")
    ).join(chosen, F.col("doc_id") == F.col("label_id"))
    return texts.select("label", "text").mapInArrow(
        partial(_sample_features, settings=settings), _FEATURES
    )


def _batches_of(order: np.ndarray, size: int) -> Iterator[np.ndarray]:
    for start in range(0, len(order), size):
        yield order[start : start + size]


def train(rows: list[tuple[float, bytes, bytes]], settings: Settings) -> Machine:
    """Logistic loss, AdaGrad, mini-batches. The order of the rows does not matter."""
    rows = sorted(rows)
    labels = np.array([r[0] for r in rows])
    total = _places_in_all(settings)
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return Machine(0.0, np.zeros(0), np.zeros((0, 0)), share)
    places = [np.frombuffer(r[1], dtype="<u4").astype(np.int64) for r in rows]
    values = [np.frombuffer(r[2], dtype="<f4").astype(np.float64) for r in rows]
    random = np.random.default_rng(settings.seed)
    weights = np.zeros(total)
    factors = random.normal(0, 0.05, (total, settings.factors))
    bias, bias_seen = 0.0, 1e-8
    weights_seen, factors_seen = np.full(total, 1e-8), np.full(factors.shape, 1e-8)
    for _ in range(settings.rounds):
        for chosen in _batches_of(random.permutation(len(rows)), settings.batch):
            at = np.concatenate([places[i] for i in chosen])
            x = np.concatenate([values[i] for i in chosen])
            sizes = np.array([len(places[i]) for i in chosen])
            starts = np.cumsum(sizes) - sizes
            scaled = factors[at] * x[:, None]
            sums = np.add.reduceat(scaled, starts, axis=0)
            squares = np.add.reduceat(scaled**2, starts, axis=0)
            linear = np.add.reduceat(weights[at] * x, starts)
            score = bias + linear + 0.5 * (sums**2 - squares).sum(axis=1)
            error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels[chosen]
            each = np.repeat(error, sizes)
            used, back = np.unique(at, return_inverse=True)
            step = np.zeros(len(used))
            np.add.at(step, back, each * x)
            pull = (each * x)[:, None] * (np.repeat(sums, sizes, axis=0) - scaled)
            turn = np.zeros((len(used), settings.factors))
            np.add.at(turn, back, pull)
            step = step / len(chosen) + settings.decay * weights[used]
            turn = turn / len(chosen) + settings.decay * factors[used]
            weights_seen[used] += step**2
            factors_seen[used] += turn**2
            weights[used] -= settings.rate * step / np.sqrt(weights_seen[used])
            factors[used] -= settings.rate * turn / np.sqrt(factors_seen[used])
            slope = float(error.mean())
            bias_seen += slope**2
            bias -= settings.rate * slope / math.sqrt(bias_seen)
    return Machine(bias, weights.astype(np.float32), factors.astype(np.float32))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Machine:
    """Train on the sample; only the sample's features reach the driver."""
    rows = labelled_sample(docs, labels, settings).collect()
    return train([(r.label, bytes(r.places), bytes(r.weights)) for r in rows], settings)


# --- scoring --------------------------------------------------------------------------


def _score(
    batches: Iterator[pa.RecordBatch], machine, buckets: int
) -> Iterator[pa.RecordBatch]:
    model: Machine = machine.value
    known = _WordPlaces(buckets)
    for batch in batches:
        for part in row_slices(batch, 1):
            texts = texts_as_bytes(part.column(1))
            scores = [model.score(*features(t, known, buckets)) for t in texts]
            columns = [part.column(0), pa.array(scores, type=pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score"])


def score(docs: DataFrame, machine: Machine, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")
    )
    scored = rows.mapInArrow(
        partial(_score, machine=sent, buckets=settings.buckets), _SCORED
    )
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def _accepted(
    batches: Iterator[pa.RecordBatch], machine, buckets: int, text_at: int
) -> Iterator[pa.RecordBatch]:
    model: Machine = machine.value
    known = _WordPlaces(buckets)
    for batch in batches:
        texts = texts_as_bytes(pa.compute.fill_null(batch.column(text_at), ""))
        keep = [model.score(*features(t, known, buckets)) >= THRESHOLD for t in texts]
        yield batch.filter(pa.array(keep))


def keep_accepted(
    docs: DataFrame, machine: Machine, settings: Settings = Settings()
) -> DataFrame:
    """``docs`` without the rows that the classifier rejects, without a shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    keep = partial(
        _accepted,
        machine=sent,
        buckets=settings.buckets,
        text_at=docs.columns.index("text"),
    )
    return docs.mapInArrow(keep, docs.schema)
