"""Did a signal for the same member occur on the day of a row, or before it?

Instead of comparing each row with all signals of its member, there are two ways whose cost
grows with rows plus signals, not with their product.

For lookbacks of some days a signal on day d is written down for the days d to d+k that it
covers; the question is then an equality of member and day.

For lookbacks of any length, the days of a member's signals become bits of blocks of 32
days, and each block is told the last signal before it. A row then finds its last signal
in the block it lies in. A signal is one bit however long the lookback is, and signals
of one member and block are merged in each task before the shuffle, so a member with a
third of all signals arrives as one row per block and task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.operators.sizing import HOT_ROWS, ROWS, key_counts, spread_join

SIGNALS = "signals"

BLOCK_BITS = 5  # a block has 2 ** 5 days: the logarithm of its bits is exact as a double
_BLOCK = "_block"
_BEFORE = "_before_"
_BITS = "_bits_"


def _bits(kinds: Sequence[str]) -> dict[str, int]:
    return {kind: 1 << n for n, kind in enumerate(kinds)}


def signal_days(
    df: DataFrame,
    key: str,
    kinds: Mapping[str, tuple[Column, str]],
    days: int,
    day: str = "day",
) -> DataFrame:
    """One row per key and covered day, with the kinds of signal that cover it.

    ``kinds`` gives for each kind the condition that makes a row a signal and the
    column with its date. ``signals`` is a number with one bit per kind, in the order
    given; read it with ``has_signal``. One scan serves all kinds, and the equal days of
    one key are merged in each task before the shuffle, however many rows it has.
    """
    if days < 0:
        raise ValueError("days must not be negative")
    bits = _bits(list(kinds))
    marks = F.array(
        *[
            F.when(
                condition & F.col(date).isNotNull(),
                F.struct(F.col(date).alias("first"), F.lit(bits[kind]).alias("bit")),
            )
            for kind, (condition, date) in kinds.items()
        ]
    )
    any_kind = reduce(or_, [condition for condition, _ in kinds.values()])
    return (
        df.where(F.col(key).isNotNull() & any_kind)
        .select(F.col(key), F.explode(marks).alias("mark"))
        .where(F.col("mark").isNotNull())
        .select(key, "mark.*", F.explode(F.sequence(F.lit(0), F.lit(days))).alias("after"))
        .select(key, "bit", F.date_add("first", F.col("after")).alias(day))
        .groupBy(key, day)
        .agg(F.bit_or("bit").alias(SIGNALS))
    )


def has_signal(kinds: Sequence[str], *wanted: str) -> Column:
    """True where one of the wanted kinds covers the row; never null."""
    bits = _bits(kinds)
    mask = reduce(or_, [bits[w] for w in wanted])
    return F.coalesce(F.col(SIGNALS), F.lit(0)).bitwiseAND(F.lit(mask)) != 0


def add_signals(
    df: DataFrame,
    covered: DataFrame,
    key: str,
    day: str,
    spread_by: Sequence[str],
    unique: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each row with the signals that cover its key and day; null where there are none.

    ``covered`` comes from ``signal_days`` with the same key and day names. With
    ``unique`` the rows hold each key and day at most once: the join then needs no
    protection and uses the partitioning both sides already have. Otherwise many rows
    may share a key and day. The covered days are first cut down to those asked for,
    where they lie, and the few that remain meet the rows with hot keys split.
    """
    on = [key, day]
    if unique:
        joined = df.join(covered, on, "left")
    else:
        counts = key_counts(df, on)
        # Always true, but it keeps the counting one shuffle, shared with the join below.
        asked = counts.where(F.col(ROWS) > 0)
        hits = covered.join(asked, on, "left_semi")
        joined = spread_join(df, hits, on, "left", spread_by, counts, hot_rows)
    return joined.select(*df.columns, SIGNALS)


def _block_of(day: Column) -> Column:
    return F.shiftright(F.unix_date(day), BLOCK_BITS)


def _place_in_block(day: Column) -> Column:
    return F.unix_date(day).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _power(exponent: Column) -> Column:
    """Two to the power of a small whole number."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), exponent)


def signal_blocks(
    df: DataFrame, key: str, kinds: Mapping[str, tuple[Column, str]]
) -> DataFrame:
    """One row per key and block of days with signals, for each kind the days as bits.

    ``kinds`` is as for ``signal_days``, and one scan serves all of them. A row without key
    or date is no signal. The rows are merged in each task before they are shuffled.
    """
    marks = F.array(
        *[
            F.when(
                condition & F.col(date).isNotNull(),
                F.struct(
                    F.col(date).alias("date"),
                    *[F.lit(other == kind).alias(_BITS + other) for other in kinds],
                ),
            )
            for kind, (condition, date) in kinds.items()
        ]
    )
    any_kind = reduce(or_, [condition for condition, _ in kinds.values()])
    bit = _power(_place_in_block(F.col("mark.date")))
    rows = (
        df.where(F.col(key).isNotNull() & any_kind)
        .select(F.col(key), F.explode(marks).alias("mark"))
        .where(F.col("mark").isNotNull())
        .select(
            key,
            _block_of(F.col("mark.date")).alias(_BLOCK),
            *[F.when(F.col("mark")[_BITS + k], bit).alias(_BITS + k) for k in kinds],
        )
    )
    return rows.groupBy(key, _BLOCK).agg(
        *[F.bit_or(_BITS + k).alias(_BITS + k) for k in kinds]
    )


def _highest(bits: Column) -> Column:
    """Number of the highest bit set, null where none is."""
    return F.when(bits > 0, F.floor(F.log2(bits.cast("double"))).cast("int"))


def _first_day(block: Column) -> Column:
    return F.shiftleft(block, BLOCK_BITS)


def carried_blocks(
    blocks: DataFrame, asked: DataFrame, key: str, kinds: Sequence[str]
) -> DataFrame:
    """Blocks with signals and blocks asked for, each with the last signal before it.

    ``asked`` has the key and ``_block``. What runs over a key here is one row per block, and
    32 days make one block, so the longest history there is makes a short window.
    """
    nothing = [F.lit(None).cast("long").alias(_BITS + k) for k in kinds]
    rows = blocks.unionByName(asked.select(key, _BLOCK, *nothing))
    merged = rows.groupBy(key, _BLOCK).agg(*[F.max(_BITS + k).alias(_BITS + k) for k in kinds])
    earlier = (
        Window.partitionBy(key).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    )
    last = [
        F.max(_first_day(F.col(_BLOCK)) + _highest(F.col(_BITS + k))).over(earlier)
        for k in kinds
    ]
    return merged.select(
        "*", *[day.alias(_BEFORE + k) for day, k in zip(last, kinds, strict=True)]
    )


def add_last_signals(
    df: DataFrame,
    blocks: DataFrame,
    kinds: Sequence[str],
    key: str,
    day: str,
    spread_by: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each row with the date of its key's last signal of each kind, the row's day included.

    ``blocks`` comes from ``signal_blocks`` with the same key and kinds. The columns are
    called ``last_`` and the kind, null where no signal came before or the row has no key or
    day. Rows of one key and block meet one entry; hot ones are split by ``spread_by``.
    """
    placed = df.withColumn(_BLOCK, _block_of(F.col(day)))
    on = [key, _BLOCK]
    counts = key_counts(placed, on)
    entries = carried_blocks(blocks, counts, key, kinds)
    joined = spread_join(placed, entries, on, "left", spread_by, counts, hot_rows)
    seen = _power(_place_in_block(F.col(day)) + 1) - 1
    last = [
        F.date_from_unix_date(
            F.coalesce(
                _first_day(F.col(_BLOCK)) + _highest(F.col(_BITS + k).bitwiseAND(seen)),
                F.col(_BEFORE + k),
            )
        ).alias(f"last_{k}")
        for k in kinds
    ]
    return joined.select(*df.columns, *last)


def came_within(kind: str, day: str, days: int) -> Column:
    """True where the last signal of a kind came on the row's day or ``days`` before at most."""
    return F.coalesce(F.datediff(day, f"last_{kind}") <= days, F.lit(False))
