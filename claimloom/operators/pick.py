"""One row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def first_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group; rows with null keys form a group like any other.

    Give an order that leaves no ties, with null placement stated. Spark keeps only
    the best row per group in every task before it shuffles (WindowGroupLimit), so a
    group of any size reaches the final task as one row per upstream task.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)
