"""Connected components of a graph of documents, as joins over stored edges.

Every round, each node passes the smallest node it knows to its neighbours (large and small
stars), which halves the depth of the trees; a path of a thousand nodes takes about ten
rounds. Tasks first join what lies in their own partition, so most paths are gone before the
first shuffle. No list of edges or nodes reaches the driver, only their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.shared import stored

_EDGES = "a long, b long"


class Forest:
    """Union-find whose roots are the smallest nodes."""

    def __init__(self) -> None:
        self._above: dict[int, int] = {}

    def root(self, node: int) -> int:
        above = self._above
        top = node
        while above.get(top, top) != top:
            top = above[top]
        while above.get(node, node) != top:
            above[node], node = top, above[node]
        return top

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        low, high = (a, b) if a < b else (b, a)
        self._above[high] = low
        self._above.setdefault(low, low)
        return True

    def edges(self) -> tuple[list[int], list[int]]:
        nodes = [n for n in self._above if self.root(n) != n]
        return nodes, [self.root(n) for n in nodes]


_FOREST_EDGES = 200_000


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest, count = Forest(), 0

    def out() -> pa.RecordBatch:
        nodes, roots = forest.edges()
        arrays = [pa.array(nodes, type=pa.int64()), pa.array(roots, type=pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

    for batch in batches:
        pairs = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        count += sum(forest.join(a, b) for a, b in pairs)
        if count >= _FOREST_EDGES:
            yield out()
            forest, count = Forest(), 0
    yield out()


def contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components: each task's own part as stars, ``a > b``."""
    return edges.select("a", "b").mapInArrow(_local, _EDGES)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of an edge; the component is its smallest node.

    ``edges`` has the columns ``a`` and ``b``, without nulls.
    """
    now = stored(contracted(edges).distinct(), "edges")
    while True:
        # large star: every node's larger neighbours are tied to its smallest one
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = (
            both.join(low, "a")
            .where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .distinct()
        )
        # small star: a node's smaller neighbours are tied to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .where(F.col("a") != F.col("b"))
            .unionByName(low.select("a", F.col("low").alias("b")))
            .distinct()
        )
        after = stored(contracted(small).distinct(), "edges")
        # done when every node hangs on one root and no root hangs on anything
        open_ends = after.select("b").distinct().join(
            after.select(F.col("a").alias("b")).distinct(), "b", "left_semi"
        )
        twice = after.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
        now = after
        if open_ends.isEmpty() and twice.isEmpty():
            break
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)

