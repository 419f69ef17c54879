"""Comparing two tables, with null equal to null only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import holds, with_prefix

BLOCKS = 1 << 14

_BLOCK = "_block"
_QUARTER = 16  # bits


def beside(expected: DataFrame, actual: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each expected row with the actual one beside it, expected columns prefixed.

    Expected rows without a partner stay, with nulls; keys are unique on both sides. Rows
    with a null in the key have no partner and are not shuffled.
    """
    named = with_prefix(expected, "expected_", keep=key)
    keyed = reduce(and_, [F.col(k).isNotNull() for k in key])
    met = named.where(keyed).join(actual, list(key), "left")
    alone = named.where(~holds(keyed)).select(
        "*",
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in actual.schema if f.name not in key],
    )
    return met.unionByName(alone)


def _hash(columns: Sequence[str], seed: int) -> Column:
    """Hash of a row; a null is a value of its own, which the hash function would pass over."""
    marked = [c for name in columns for c in (F.col(name), F.col(name).isNull())]
    return F.xxhash64(F.lit(seed), *marked)


def digest_sums(columns: Sequence[str], sign: Column | None = None) -> dict[str, Column]:
    """Sums that tell the rows of two tables apart whatever their order, as aggregates.

    Two hashes of each row are added up in pieces of 16 bits, which leaves room for 2 ** 47
    rows in a sum. Tables with other rows have other sums but for a chance of 1 in 2 ** 100 or so.
    """
    one = F.lit(1).cast("long") if sign is None else sign
    zero = F.lit(0).cast("long")
    sums = {"n": F.coalesce(F.sum(one), zero)}
    for seed in (1, 2):
        value = _hash(columns, seed)
        for shift in range(0, 64, _QUARTER):
            piece = F.shiftright(value, shift).bitwiseAND(F.lit((1 << _QUARTER) - 1).cast("long"))
            sums[f"sum{seed}_{shift}"] = F.coalesce(F.sum(piece * one), zero)
    return sums


def differing_blocks(
    expected: DataFrame, actual: DataFrame, by: Sequence[str], blocks: int = BLOCKS
) -> DataFrame:
    """The numbers of the blocks whose rows are not the same on both sides.

    A row's block is a hash of ``by``. One row per block and task is shuffled, whatever the tables
    hold: the rows of one side count as negative, so that equal blocks add up to nothing.
    """
    columns = expected.columns

    def signed(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*columns, F.lit(sign).cast("long").alias("_sign"))

    both = signed(expected, 1).union(signed(actual, -1))
    sums = digest_sums(columns, F.col("_sign"))
    per_block = both.groupBy(block_of(by, blocks).alias(_BLOCK)).agg(
        *[total.alias(name) for name, total in sums.items()]
    )
    return per_block.where(reduce(or_, [F.col(s) != 0 for s in sums])).select(_BLOCK)


def block_of(by: Sequence[str], blocks: int) -> Column:
    """Block of a row; a null is a value like any other."""
    return F.pmod(_hash(by, 0), F.lit(blocks).cast("long"))


def differences(
    expected: DataFrame, actual: DataFrame, key: Sequence[str], blocks: int = BLOCKS
) -> DataFrame:
    """One row per key, column and value that the two tables hold a different number of times.

    Values are shown as text. Rows on one side only show up with all their columns. There
    is no join of rows: first the tables are compared by digests of blocks of rows, then the
    rows of blocks that differ go into one count per whole row, equal rows cancel, and only
    the rest is taken apart by column. Equal tables shuffle nothing but digests, and
    repeated or null keys do no harm. Both tables are read twice, so store what takes long
    to derive. The broadcast list of blocks has ``blocks`` numbers at most. Tables with key
    columns only show their rows with a null column and value. Both tables must have the
    same columns with the same types.
    """
    types = [{f.name: f.dataType for f in df.schema} for df in (expected, actual)]
    if types[0] != types[1]:
        odd = sorted({n for n, _ in set(types[0].items()) ^ set(types[1].items())})
        raise ValueError(f"the two tables differ in the columns or types of: {', '.join(odd)}")
    columns = expected.columns
    values = [c for c in columns if c not in key]
    actual = actual.select(*columns)
    # the whole row decides its block, so that the rows of a hot key lie in many blocks
    other = F.broadcast(differing_blocks(expected, actual, columns, blocks))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def suspects(df: DataFrame) -> DataFrame:
        placed = df.withColumn(_BLOCK, block_of(columns, blocks))
        return placed.join(other, _BLOCK, "left_semi").drop(_BLOCK)

    def counted(df: DataFrame, by: Sequence[str]) -> DataFrame:
        return (
            df.groupBy(*by)
            .agg(
                F.sum("n_expected").alias("n_expected"), F.sum("n_actual").alias("n_actual")
            )
            .where(F.col("n_expected") != F.col("n_actual"))
        )

    both = suspects(expected).select(
        *columns, one.alias("n_expected"), zero.alias("n_actual")
    ).union(suspects(actual).select(*columns, zero.alias("n_expected"), one.alias("n_actual")))
    if not values:
        text = F.lit(None).cast("string")
        return counted(both, columns).select(
            *key, text.alias("column"), text.alias("value"), "n_expected", "n_actual"
        )
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in values
        ]
    )
    taken_apart = counted(both, columns).select(
        *key, "n_expected", "n_actual", F.inline(cells)
    )
    return counted(taken_apart, [*key, "column", "value"])


def field_differences(
    df: DataFrame, key: Sequence[str], expected: str, actual: str
) -> DataFrame:
    """What ``differences`` gives, for two structs of the same fields in one row.

    ``key`` is unique. Nothing is shuffled.
    """
    fields = df.schema[expected].dataType.names
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def cell(side: str, name: str, n_expected: Column, n_actual: Column) -> Column:
        differs = ~F.col(expected)[name].eqNullSafe(F.col(actual)[name])
        shown = F.struct(
            F.lit(name).alias("column"),
            F.col(side)[name].cast("string").alias("value"),
            n_expected.alias("n_expected"),
            n_actual.alias("n_actual"),
        )
        return F.when(differs, shown)

    cells = [
        c
        for name in fields
        for c in (cell(expected, name, one, zero), cell(actual, name, zero, one))
    ]
    return df.select(*key, F.explode(F.array_compact(F.array(*cells))).alias("cell")).select(
        *key, "cell.*"
    )


def miss_counts(found: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of keys that differ, per column, from the rows of ``differences``."""
    return (
        found.select(*key, "column")
        .distinct()
        .groupBy("column")
        .agg(F.count("*").alias("n_misses"))
    )


def field_miss_counts(df: DataFrame, expected: str, actual: str) -> DataFrame:
    """Number of rows whose two structs differ, per field that differs somewhere."""
    fields = df.schema[expected].dataType.names
    differs = [
        F.count_if(~F.col(expected)[name].eqNullSafe(F.col(actual)[name])) for name in fields
    ]
    counts = df.agg(*[n.alias(name) for n, name in zip(differs, fields, strict=True)])
    rows = [F.struct(F.lit(f).alias("column"), F.col(f).alias("n_misses")) for f in fields]
    return counts.select(F.inline(F.array(*rows))).where(F.col("n_misses") > 0)
