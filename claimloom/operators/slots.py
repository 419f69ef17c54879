"""Wide slots to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def slots_to_rows(
    df: DataFrame,
    slots: Sequence[str],
    keep: Sequence[str],
    position: str = "position",
    value: str = "code",
) -> DataFrame:
    """One row per filled slot with the slot's place, counted from 0 over all slots.

    Empty slots give no row but keep their number, so gaps show in the positions.
    A narrow step: no shuffle.
    """
    if not slots:
        raise ValueError("no slot columns to turn into rows")
    filled = F.coalesce(*[F.col(s) for s in slots]).isNotNull()
    return (
        df.where(filled)
        .select(*keep, F.posexplode(F.array(*slots)).alias(position, value))
        .where(F.col(value).isNotNull())
    )
