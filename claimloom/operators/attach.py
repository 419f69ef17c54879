"""Put a result back on the lines it came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import holds


def attach(lines: DataFrame, result: DataFrame, key: str, can_match: Column) -> DataFrame:
    """Every line once, with the result's columns, null where it has no result row.

    ``result`` holds at most one row per key, and only for lines where ``can_match`` is
    true. Just those lines are shuffled to meet it; the rest, and lines without a key,
    pass straight from the scan.
    """
    matching = can_match & F.col(key).isNotNull()
    added = [f for f in result.schema if f.name != key]
    met = lines.where(matching).join(result, key, "left")
    passed = lines.where(~holds(matching)).select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added]
    )
    columns = [*lines.columns, *[f.name for f in added]]
    return met.select(*columns).union(passed.select(*columns))
