"""What several operators need: the shared folder, free column names, texts from Arrow."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.sources import new_shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share; it goes when the session's driver ends."""
    return f"{new_shared_folder(spark)}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends here."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(taken: Iterable[str], wish: str) -> str:
    """``wish``, with underscores put before it until no column has that name."""
    lower = {t.lower() for t in taken}
    while wish.lower() in lower:
        wish = "_" + wish
    return wish


def whole_text(column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text of an Arrow string column without nulls."""
    return column.cast(pa.large_binary()).to_pylist()


def table_batches(
    rows: Iterator[tuple], schema: pa.Schema, size: int = 20_000
) -> Iterator[pa.RecordBatch]:
    """Tuples gathered into Arrow batches of ``size`` rows."""
    kept: list[tuple] = []
    for row in rows:
        kept.append(row)
        if len(kept) >= size:
            yield _batch(kept, schema)
            kept = []
    if kept:
        yield _batch(kept, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def row_slices(batch: pa.RecordBatch, texts: int, most: int = 4_000_000):
    """Parts of a batch whose texts (column number ``texts``) have ``most`` bytes or so."""
    sizes = pa.compute.binary_length(batch.column(texts)).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        total += size or 0
        if total >= most:
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0
    if start < len(sizes):
        yield batch.slice(start)


def row_groups(batches: Iterable[pa.RecordBatch], texts: int, most: int) -> Iterator[pa.Table]:
    """Rows with ``most`` bytes or so, but twice that at most, unless one text has more.

    Large batches are cut, by their texts (column number ``texts``), small ones put together.
    """
    kept, size = [], 0
    for batch in batches:
        for part in row_slices(batch, texts, most):
            kept.append(part)
            size += part.nbytes
            if size >= most:
                yield pa.Table.from_batches(kept)
                kept, size = [], 0
    if kept:
        yield pa.Table.from_batches(kept)
