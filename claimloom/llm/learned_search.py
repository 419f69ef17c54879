"""Nearest neighbours by learned partitions (operator 8).

On a bounded sample the neighbour graph is cut into balanced parts, and a small network
learns in which parts the neighbours of a vector lie. It then routes every row to its most
probable part, and every query to its most probable parts, whose rows are ranked by their
exact inner product. How many parts a query looks into is measured: a share of the sample
is kept from the fit, and the fewest parts are taken in which those vectors find ``recall``
of their true neighbours. Vectors with clear groups need few, vectors that are mostly
noise need most parts. A query whose parts hold too few rows looks into further ones, so that
it always gets as many rows as it asks for, if there are so many. A part with very many rows
is dealt out in chunks of ``chunk_rows``; nothing is left out of it.

Defined results: vectors that are null, zero, of another length than most, or that hold a
null or non-finite component take no part, nor do rows without ``vec_id``; of rows with
one ``vec_id`` the smallest vector counts; ties go to the smaller ``vec_id``; an empty
table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.shared import stored

_ROUTED = "vec_id long, vector array<double>, part int, place int"
_FOUND = "query_id long, ids array<long>, scores array<double>"


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the rows that the parts and the network are fitted on, and
    ``most_parts`` their number; ``neighbours`` are the edges per vector of the graph."""

    part_rows: int = 1024
    most_parts: int = 512
    recall: float = 0.95
    chunk_rows: int = 2048
    query_rows: int = 20_000
    sample_rows: int = 8192
    sample_per_part: int = 128
    neighbours: int = 12
    hidden: int = 64
    rounds: int = 40
    slack: float = 1.1
    seed: int = 11


# --- fitting on the sample --------------------------------------------------------------


def neighbour_graph(vectors: np.ndarray, neighbours: int) -> np.ndarray:
    """For each row the rows with the largest inner product, itself left out."""
    count = min(neighbours, len(vectors) - 1)
    found = np.empty((len(vectors), count), dtype=np.int64)
    for start in range(0, len(vectors), 512):
        scores = vectors[start : start + 512] @ vectors.T
        scores[np.arange(len(scores)), np.arange(start, start + len(scores))] = -np.inf
        found[start : start + 512] = np.argpartition(-scores, count - 1, axis=1)[:, :count]
    return found


def _undirected(graph: np.ndarray) -> list[list[int]]:
    edges: list[list[int]] = [[] for _ in graph]
    for a, row in enumerate(graph.tolist()):
        for b in row:
            edges[a].append(b)
            edges[b].append(a)
    return edges


def balanced_parts(graph: np.ndarray, parts: int, slack: float, rounds: int = 8) -> np.ndarray:
    """Parts of nearly equal size that cut few edges.

    Rows in breadth-first order are dealt out in equal runs; then each row moves to the part
    of most of its neighbours while that part has room.
    """
    edges = _undirected(graph)
    order: list[int] = []
    seen = [False] * len(edges)
    for root in range(len(edges)):
        if seen[root]:
            continue
        seen[root] = True
        queue = [root]
        for node in queue:
            order.append(node)
            for other in edges[node]:
                if not seen[other]:
                    seen[other] = True
                    queue.append(other)
    part = [0] * len(edges)
    for place, node in enumerate(order):
        part[node] = place * parts // len(order)
    room = math.ceil(slack * len(edges) / parts)
    sizes = np.bincount(part, minlength=parts).tolist()
    for _ in range(rounds):
        moved = 0
        for node in order:
            near: dict[int, int] = {}
            for other in edges[node]:
                near[part[other]] = near.get(part[other], 0) + 1
            home = part[node]
            best, gain = home, near.get(home, 0)
            for p, n in near.items():
                if n > gain and sizes[p] < room:
                    best, gain = p, n
            if best != home:
                sizes[home] -= 1
                sizes[best] += 1
                part[node] = best
                moved += 1
        if not moved:
            break
    return np.array(part)


@dataclass(frozen=True)
class Router:
    """One hidden layer; gives the log-probability of each part, up to a constant."""

    scale: float
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray

    def parts(self, vectors: np.ndarray, probes: int) -> np.ndarray:
        """The most probable parts of each vector, most probable first."""
        hidden = np.maximum(vectors * self.scale @ self.first + self.first_bias, 0)
        scores = hidden @ self.second + self.second_bias
        return np.argsort(-scores, axis=1, kind="stable")[:, :probes]


def train_router(
    vectors: np.ndarray, part: np.ndarray, graph: np.ndarray, parts: int, settings: Settings
) -> Router:
    """Cross entropy against the parts of each row and its neighbours; Adam."""
    random = np.random.default_rng(settings.seed)
    target = np.zeros((len(vectors), parts))
    for near in [np.arange(len(vectors)), *graph.T]:
        np.add.at(target, (np.arange(len(vectors)), part[near]), 1.0)
    target /= target.sum(axis=1, keepdims=True)
    scale = 1 / max(1e-12, float(np.sqrt((vectors**2).mean())))
    x = vectors * scale
    size = x.shape[1]
    values = [
        random.normal(0, math.sqrt(2 / size), (size, settings.hidden)),
        np.zeros(settings.hidden),
        random.normal(0, math.sqrt(2 / settings.hidden), (settings.hidden, parts)),
        np.zeros(parts),
    ]
    mean, square = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(settings.rounds):
        order = random.permutation(len(x))
        for start in range(0, len(x), 64):
            chosen = order[start : start + 64]
            a = x[chosen]
            before = a @ values[0] + values[1]
            hidden = np.maximum(before, 0)
            scores = hidden @ values[2] + values[3]
            scores -= scores.max(axis=1, keepdims=True)
            chance = np.exp(scores)
            chance /= chance.sum(axis=1, keepdims=True)
            error = (chance - target[chosen]) / len(chosen)
            back = (error @ values[2].T) * (before > 0)
            slopes = [a.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for i, slope in enumerate(slopes):
                mean[i] = 0.9 * mean[i] + 0.1 * slope
                square[i] = 0.999 * square[i] + 0.001 * slope**2
                rate = 0.002 * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                values[i] = values[i] - rate * mean[i] / (np.sqrt(square[i]) + 1e-8)
    return Router(scale, *values)


def fit_router(vectors: np.ndarray, parts: int, settings: Settings) -> Router:
    """Graph, parts and network for the sampled vectors."""
    size = vectors.shape[1] if vectors.ndim == 2 else 1
    if parts == 1 or len(vectors) < 2 * parts:
        return Router(1.0, np.zeros((size, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    graph = neighbour_graph(vectors, settings.neighbours)
    part = balanced_parts(graph, parts, settings.slack)
    return train_router(vectors, part, graph, parts, settings)


def probes_needed(vectors: np.ndarray, kept: np.ndarray, router: Router, top: int, recall: float):
    """Fewest parts in which the vectors ``kept`` from the fit find enough true neighbours."""
    parts = len(router.second_bias)
    if parts == 1 or not len(kept):
        return parts
    homes = router.parts(vectors, 1)[:, 0]
    routes = router.parts(vectors[kept], parts)
    scores = vectors[kept] @ vectors.T
    scores[np.arange(len(kept)), kept] = -np.inf
    count = min(top, len(vectors) - 1)
    near = np.argpartition(-scores, count - 1, axis=1)[:, :count]
    # at which probe the part of each true neighbour is looked into
    probe = (routes[:, None, :] == homes[near][:, :, None]).argmax(axis=2)
    for probes in range(1, parts):
        if (probe < probes).mean() >= recall:
            return probes
    return parts


# --- the search -------------------------------------------------------------------------


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, vector`` of the rows that take part, one row per ``vec_id``."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    good = F.forall("vector", finite) & F.exists("vector", lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False)))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def _route(
    batches: Iterator[pa.RecordBatch], router: Router, probes: int, held: np.ndarray, least: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        order = router.parts(_matrix(batch.column(1)), len(held))
        short = np.cumsum(held[order], axis=1) < least
        taken = np.maximum(short.sum(axis=1) + 1, probes)
        rows, places = np.nonzero(np.arange(order.shape[1]) < taken[:, None])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(rows)),
                batch.column(1).take(pa.array(rows)),
                pa.array(order[rows, places].astype(np.int32)),
                pa.array(places.astype(np.int32)),
            ],
            names=["vec_id", "vector", "part", "place"],
        )


def _routed(
    rows: DataFrame, router: Router, probes: int, held: np.ndarray, least: int = 0
) -> DataFrame:
    """Rows with their ``probes`` most probable parts, and as many more as hold ``least`` rows.

    ``held`` is the number of rows in each part.
    """
    route = partial(_route, router=router, probes=probes, held=held, least=least)
    return rows.mapInArrow(route, _ROUTED)


def _nearest(queries: pa.Table, rows: pa.Table, top: int) -> pa.Table:
    """The best rows of one chunk for each query sent to it.

    A matrix product shortlists; what it finds is ranked by sums that are formed alike for
    every row, so equal vectors have equal scores wherever they are stored.
    """
    names = ["query_id", "ids", "scores"]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
    out: list[list] = [[], [], []]
    if len(queries) and len(rows):
        ids, stock = rows.column("vec_id").to_numpy(), _matrix(rows.column("vector"))
        order = np.argsort(ids, kind="stable")
        ids, stock = ids[order], stock[order]
        longest = float(np.sqrt((stock**2).sum(axis=1)).max())
        wanted, asked = queries.column("vec_id").to_numpy(), _matrix(queries.column("vector"))
        for start in range(0, len(asked), 256):
            scores = asked[start : start + 256] @ stock.T
            for q, own, row in zip(
                asked[start : start + 256], wanted[start : start + 256], scores, strict=True
            ):
                count = min(top + 1, len(row))  # one more, for the query's own row
                least = np.partition(row, len(row) - count)[len(row) - count]
                blur = 1e-12 * longest * float(np.sqrt((q**2).sum())) * len(q)
                near = np.flatnonzero((row >= least - blur) & (ids != own))
                exact = (stock[near] * q).sum(axis=1)
                best = np.argsort(-exact, kind="stable")[:top]  # ids ascend
                out[0].append(int(own))
                out[1].append(ids[near][best])
                out[2].append(exact[best])
    arrays = [pa.array(c, type=k) for c, k in zip(out, kinds, strict=True)]
    return pa.Table.from_arrays(arrays, names=names)


def search(
    embeddings: DataFrame, is_query: Column, top: int = 20, settings: Settings = Settings()
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the rows nearest to each query row.

    ``is_query`` is a condition on ``vec_id``. Every usable row is indexed.
    """
    rows = stored(usable(embeddings), "vectors")
    lengths = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), "size").first()
    size, total = (most["size"], most["n"]) if most else (1, 0)
    rows = rows.where(F.size("vector") == size)

    parts = max(1, min(settings.most_parts, math.ceil(total / settings.part_rows)))
    wanted = min(settings.sample_rows, max(2048, parts * settings.sample_per_part))
    scale = 1 << 30
    share = min(scale, int(scale * wanted / max(1, total)))
    sample = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(scale)) < share)
    sampled = sorted((r.vec_id, r.vector) for r in sample.limit(2 * wanted).collect())
    # equal vectors say nothing more about the parts
    distinct = list(dict.fromkeys(tuple(v) for _, v in sampled))
    vectors = np.array(distinct, dtype=np.float64).reshape(len(distinct), size)
    mixed = np.random.default_rng(settings.seed).permutation(len(vectors))
    kept = mixed[: min(512, len(vectors) // 4)]
    router = fit_router(np.delete(vectors, kept, axis=0), parts, settings)
    probes = probes_needed(vectors, kept, router, top, settings.recall)

    held = np.zeros(len(router.second_bias), dtype=np.int64)
    index = stored(_routed(rows, router, 1, held).drop("place"), "index")
    counts = index.groupBy("part").agg(F.count("*").alias("n"))
    for row in counts.collect():  # at most ``most_parts``
        held[row["part"]] = row["n"]
    chunks = counts.select(
        F.col("part").alias("chunk_part"),
        F.ceil(F.col("n") / settings.chunk_rows).cast("int").alias("chunks"),
    )
    chunks = F.broadcast(chunks)  # one row per part, at most ``most_parts``
    chosen = rows.where(is_query)
    # queries come in batches, so that no task gets all of a large set
    batches = max(1, math.ceil(chosen.count() / settings.query_rows))
    batch = F.pmod(F.xxhash64("vec_id"), F.lit(batches)).cast("int")
    place = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("chunks")).cast("int")
    every_batch = F.explode(F.sequence(F.lit(0), F.lit(batches - 1)))
    key = ["part", "chunk", "batch"]
    stock = (
        index.join(chunks, F.col("part") == F.col("chunk_part"))
        .select("vec_id", "vector", "part", place.alias("chunk"), every_batch.alias("batch"))
    )
    every_chunk = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    asked = (
        # one more than wanted, for the query's own row
        _routed(chosen, router, probes, held, top + 1)
        .join(chunks, F.col("part") == F.col("chunk_part"))
        .select("vec_id", "vector", "part", every_chunk.alias("chunk"), batch.alias("batch"))
    )

    def nearest(queries: pa.Table, rows: pa.Table) -> pa.Table:
        return _nearest(queries, rows, top)

    found = asked.groupBy(*key).cogroup(stock.groupBy(*key)).applyInArrow(nearest, _FOUND)
    # a few sorted lists per query, one from each chunk it looked into
    pair = F.transform(
        F.arrays_zip("ids", "scores"),
        lambda p: F.struct((-p["scores"]).alias("less"), p["ids"].alias("vec_id")),
    )
    lists = found.select("query_id", pair.alias("pairs"))
    merged = lists.groupBy("query_id").agg(F.flatten(F.collect_list("pairs")).alias("pairs"))
    best = F.slice(F.array_sort("pairs"), 1, top)
    return merged.select("query_id", F.posexplode(best).alias("place", "pair")).select(
        "query_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("pair.vec_id").alias("vec_id"),
        (-F.col("pair.less")).alias("score"),
    )
