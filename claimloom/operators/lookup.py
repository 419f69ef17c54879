"""Joins to code tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.operators.sizing import fits_broadcast, spread_join


def lookup(
    df: DataFrame,
    codes: DataFrame,
    on: str,
    code: str = "code",
    take: Sequence[str] = ("ccs",),
    spread_by: Sequence[str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Add ``take`` from the code table to each row whose code is listed.

    Rows without a listed code go; a code with several entries gives a row for each.
    ``small`` says whether the code table may be broadcast; left out, its size is measured.
    """
    table = codes.where(F.col(code).isNotNull()).select(F.col(code).alias(on), *take)
    if small is None:
        small = fits_broadcast(table)
    if small:
        joined = df.join(F.broadcast(table), on, "inner")
    else:
        joined = spread_join(
            df.where(F.col(on).isNotNull()), table, [on], "inner", spread_by or df.columns
        )
    return joined.select(*df.columns, *take)


def keep_pairs(
    df: DataFrame,
    pairs: DataFrame,
    on: Mapping[str, str],
    spread_by: Sequence[str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Keep the rows whose values occur together in one row of ``pairs``.

    ``on`` maps columns of ``df`` to columns of ``pairs``. A null on either side never
    matches, and a pair listed twice does not repeat rows.
    """
    table = pairs.select(*[F.col(p).alias(d) for d, p in on.items()]).dropna()
    if small is None:
        small = fits_broadcast(table)
    if small:
        kept = df.join(F.broadcast(table), list(on), "left_semi")
    else:
        kept = spread_join(
            df.dropna(subset=list(on)),
            table.distinct(),
            list(on),
            "left_semi",
            spread_by or df.columns,
        )
    return kept.select(*df.columns)
