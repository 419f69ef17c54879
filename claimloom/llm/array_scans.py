"""Array functions for long arrays and texts, in time that hardly grows faster than they do.

Adding to an array element by element copies it each time. Here arrays are cut into blocks
of about the square root of their length, so that only blocks are copied. All of it is made
of Spark's own functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHORT = 64
_TEXT_BLOCK = 256

Merge = Callable[[Column, Column], Column]


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _scan(values: Column, start: Column, merge: Merge) -> Column:
    begin = F.struct(start.alias("last"), F.array().cast("array<bigint>").alias("out"))

    def step(state: Column, value: Column) -> Column:
        last = merge(state["last"], value)
        return F.struct(last.alias("last"), F.concat(state["out"], F.array(last)).alias("out"))

    return F.aggregate(values, begin, step, lambda state: state["out"])


def running(values: Column, start: int, merge: Merge) -> Column:
    """Each whole number merged with all before it; ``start`` changes nothing when merged."""
    first = F.lit(start).cast("long")

    def in_blocks(v: Column) -> Column:
        width = F.greatest(F.lit(_SHORT), F.ceil(F.sqrt(F.size(v).cast("double"))).cast("int"))
        last_block = F.floor((F.size(v) - 1) / width).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), last_block),
            lambda b: _scan(F.slice(v, b * width + 1, width), first, merge),
        )

        def joined(found: Column) -> Column:
            totals = _scan(F.transform(found, lambda b: F.element_at(b, -1)), first, merge)
            before = F.concat(F.array(first), totals)
            each = F.zip_with(
                found,
                F.slice(before, F.lit(1), F.size(found)),
                lambda block, b: F.transform(block, lambda x: merge(b, x)),
            )
            return F.flatten(each)

        return bound(blocks, joined)

    return bound(
        values,
        lambda v: F.when(F.size(v) <= _SHORT, _scan(v, first, merge)).otherwise(in_blocks(v)),
    )


def distinct_sorted(values: Column) -> Column:
    """The distinct elements in order; unlike ``array_distinct`` quick for structs too."""
    return bound(
        F.array_sort(values),
        lambda v: F.filter(v, lambda x, i: (i == 0) | ~x.eqNullSafe(F.get(v, i - 1))),
    )


def text_blocks(text: Column) -> Column:
    """The text in blocks of equally many characters, for ``cut``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_TEXT_BLOCK}}}"), F.lit(0))


def cut(blocks: Column, at: Column, length: Column) -> Column:
    """``length`` characters from place ``at``, without going through the text before them."""
    inside = at % _TEXT_BLOCK
    first = F.floor(at / _TEXT_BLOCK).cast("int") + 1
    count = F.floor((inside + length) / _TEXT_BLOCK).cast("int") + 1
    near = F.array_join(F.slice(blocks, first, count), "")
    return F.substr(near, (inside + 1).cast("int"), length.cast("int"))
