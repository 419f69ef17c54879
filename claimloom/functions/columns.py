"""Small column helpers. All are JVM-side expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def holds(condition: Column) -> Column:
    """A condition with SQL's unknown read as false, so that it can be negated."""
    return F.coalesce(condition, F.lit(False))


def as_yes_no(condition: Column) -> Column:
    """``Y`` where the condition is true, ``N`` where it is false or unknown."""
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def in_any_set(sets: Mapping[str, Iterable[str]]) -> Column:
    """True where at least one column holds a member of the set given for it.

    A null in one column leaves the others in force. Without a match and with a null
    the answer is unknown: as a filter or in ``when`` that is false, and the test can
    still be pushed down to the scan. Before negating, wrap it in ``holds``.
    """
    return reduce(or_, [F.col(name).isin(list(values)) for name, values in sets.items()])


def starts_with_any(name: str, prefixes: Sequence[str]) -> Column:
    """True where the column starts with one of the prefixes; unknown for null."""
    return reduce(or_, [F.col(name).startswith(p) for p in prefixes])


def numbered_columns(df: DataFrame, stem: str) -> list[str]:
    """Columns called stem1, stem2, ... in order of their number.

    The number decides, so a reordered table gives the same slot positions.
    """
    pattern = re.compile(re.escape(stem) + r"(\d+)")
    found = [(int(m.group(1)), c) for c in df.columns if (m := pattern.fullmatch(c))]
    return [c for _, c in sorted(found)]


def with_prefix(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Put a prefix before every column name but those to keep."""
    return df.select(
        *[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns]
    )
