"""Checks that a result is one well-formed row per line."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import holds


def check_names(result: DataFrame, key: list[str], valid: Callable[[str], bool]) -> None:
    """Raise unless the result is the key plus columns whose names are valid."""
    missing = [k for k in key if k not in result.columns]
    if missing:
        raise ValueError(f"result lacks key columns: {', '.join(missing)}")
    bad = [c for c in result.columns if c not in key and not valid(c)]
    if bad:
        raise ValueError(f"column names break the naming rule: {', '.join(bad)}")


def require_unique(df: DataFrame, key: str) -> None:
    """Raise if a key occurs twice; rows without a key do not count.

    Runs one job that reads the key column only and shuffles each key once per task.
    """
    repeated = df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")
    found = repeated.orderBy(key).limit(3).collect()
    if found:
        raise ValueError(f"{key} is not unique: {', '.join(str(r[key]) for r in found)}")


def contract_report(
    lines: DataFrame, result: DataFrame, key: str, must_hold: Mapping[str, Column]
) -> DataFrame:
    """One row of counts: rows on each side, then one count per way to be wrong.

    ``must_hold`` names conditions on the result's rows; unknown counts as broken. The two
    tables are counted per key in one grouping with partial sums, without a join, so
    repeated keys cannot multiply rows.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    broken = {f"n_broken_{name}": ~holds(rule) for name, rule in must_hold.items()}
    sides = lines.select(
        F.col(key), one.alias("in_lines"), zero.alias("in_result"), *[zero.alias(b) for b in broken]
    ).unionByName(
        result.select(
            F.col(key),
            zero.alias("in_lines"),
            one.alias("in_result"),
            *[F.when(wrong, one).otherwise(zero).alias(b) for b, wrong in broken.items()],
        )
    )
    per_key = sides.groupBy(key).agg(
        *[F.sum(c).alias(c) for c in ("in_lines", "in_result", *broken)]
    )
    has_key = F.col(key).isNotNull()
    in_lines, in_result = F.col("in_lines"), F.col("in_result")

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("long")

    return per_key.agg(
        total(in_lines).alias("n_lines"),
        total(in_result).alias("n_result"),
        total(F.when(~has_key, in_lines + in_result)).alias("n_null_key_rows"),
        F.count_if(has_key & ((in_lines > 1) | (in_result > 1))).alias("n_repeated_keys"),
        F.count_if(has_key & (in_result == 0)).alias("n_missing_keys"),
        F.count_if(has_key & (in_lines == 0)).alias("n_extra_keys"),
        *[total(F.col(b)).alias(b) for b in broken],
    )


def enforce(report: DataFrame) -> None:
    """Raise if a contract report counts anything wrong. Runs the report."""
    counts = report.first().asDict()
    problems = {k: v for k, v in counts.items() if k not in ("n_lines", "n_result") and v}
    if counts["n_lines"] != counts["n_result"]:
        problems["n_lines"], problems["n_result"] = counts["n_lines"], counts["n_result"]
    if problems:
        raise ValueError(f"output contract broken: {problems}")
