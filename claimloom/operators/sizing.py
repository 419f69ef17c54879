"""How a join meets a second table of unknown size or with hot keys.

A table is broadcast only after its size has been measured. Beyond the limit the join
shuffles, with the hottest keys split, so that a key holding a third of all rows does not
end in one task. Neither way drops rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 * 1024 * 1024
HOT_ROWS = 1_000_000
HOT_KEYS = 100_000
ROWS = "_rows"

_ROW_OVERHEAD = 64
_VALUE_BYTES = 16
_PARTS = "_parts"
_SALT = "_salt"


def _row_bytes(df: DataFrame) -> Column:
    def size(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.NumericType, T.DatetimeType, T.BooleanType)):
            return F.lit(_VALUE_BYTES)
        return F.coalesce(F.octet_length(F.col(field.name).cast("string")), F.lit(0))

    sizes = [size(field) for field in df.schema]
    return reduce(add, sizes, F.lit(_ROW_OVERHEAD)).cast("long")


def measured_bytes(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Bytes of each table, by one distributed sum of the row sizes of all of them.

    The sizes are measured, no estimates of the planner, and cost one pass over the tables.
    """
    named = [
        t.select(F.lit(name).alias("name"), _row_bytes(t).alias("bytes"))
        for name, t in tables.items()
    ]
    sums = reduce(DataFrame.union, named).groupBy("name").agg(F.sum("bytes").alias("bytes"))
    found = {r["name"]: r["bytes"] for r in sums.collect()}
    return {name: found.get(name, 0) for name in tables}


def may_broadcast(
    tables: Mapping[str, DataFrame], max_bytes: int = BROADCAST_BYTES
) -> dict[str, bool]:
    """Which of the tables to send to every executor: the smallest, while their sum fits."""
    sizes = measured_bytes(tables)
    chosen, total = {}, 0
    for name in sorted(tables, key=sizes.__getitem__):
        total += sizes[name]
        chosen[name] = total <= max_bytes
    return chosen


def fits_broadcast(*tables: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the tables together are small enough to send to every executor."""
    named = {str(n): t for n, t in enumerate(tables)}
    return sum(measured_bytes(named).values()) <= max_bytes


def key_counts(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Number of rows per key, keys with a null left out; merged in each task first."""
    return df.select(*on).dropna().groupBy(*on).agg(F.count("*").alias(ROWS))


def spread_join(
    df: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str,
    spread_by: Sequence[str],
    counts: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Shuffle join of ``df`` to ``table`` that splits the hot keys of ``df``.

    A key with more than ``hot_rows`` rows is split into parts of about that many, and
    only for such keys are the rows of ``table`` repeated, once per part: a key with e
    entries there gives e times its rows / ``hot_rows``. The list of split keys is broadcast
    and holds the ``hot_keys`` hottest at most, whatever the data; a key beyond it stays
    whole and has at most rows / ``hot_keys`` rows. Rows with a null key match nothing and are
    scattered. The part is a hash of ``spread_by``, hence the same when a lost task is run
    again. ``counts`` may pass in ``key_counts`` of ``df``.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"cannot spread a {how} join")
    on = list(on)
    if counts is None:
        counts = key_counts(df, on)
    hottest = (
        counts.where(F.col(ROWS) > hot_rows).orderBy(F.desc(ROWS), *on).limit(hot_keys)
    )
    hot = F.broadcast(hottest.select(*on, F.ceil(F.col(ROWS) / hot_rows).alias(_PARTS)))
    parts = F.coalesce(_PARTS, F.lit(1).cast("long"))
    place = F.xxhash64(*spread_by)
    no_key = reduce(or_, [F.col(c).isNull() for c in on])
    rows = df if how == "left" else df.dropna(subset=on)
    salted = (
        rows.join(hot, on, "left")
        .withColumn(_SALT, F.when(no_key, place).otherwise(F.pmod(place, parts)))
        .drop(_PARTS)
    )
    entries = (
        table.join(hot, on, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .drop(_PARTS)
    )
    return salted.join(entries, [*on, _SALT], how).drop(_SALT)
