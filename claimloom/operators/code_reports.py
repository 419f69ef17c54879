"""Reports on a code table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def code_conflicts(codes: DataFrame) -> DataFrame:
    """Codes that stand for more than one category, with their number of categories."""
    return (
        codes.where(F.col("ccs").isNotNull())
        .groupBy("code_type", "code")
        .agg(
            F.count_distinct("ccs").alias("n_categories"),
            F.min("ccs").alias("first_category"),
            F.max("ccs").alias("last_category"),
        )
        .where(F.col("n_categories") > 1)
    )


def code_coverage(
    codes: DataFrame, types: Mapping[str, str], named: Sequence[str] = ()
) -> DataFrame:
    """Number of entries per category and code type, and the types a category lacks.

    ``types`` maps table names to code types. Categories in ``named`` are listed even
    if no entry has them, with 0 everywhere.
    """
    counts = codes.where(F.col("ccs").isNotNull()).groupBy("ccs").agg(
        *[F.count_if(F.col("code_type") == t).alias(f"n_{name}") for name, t in types.items()]
    )
    if named:
        listed = F.explode(F.array(*[F.lit(c) for c in named])).alias("ccs")
        zeros = codes.sparkSession.range(1, numPartitions=1).select(
            listed, *[F.lit(0).cast("long").alias(f"n_{n}") for n in types]
        )
        counts = (
            counts.unionByName(zeros)
            .groupBy("ccs")
            .agg(*[F.sum(f"n_{n}").alias(f"n_{n}") for n in types])
        )
    lacks = F.concat_ws(",", *[F.when(F.col(f"n_{n}") == 0, F.lit(n)) for n in types])
    return counts.withColumn("missing", lacks)
