"""Column expressions and the fixed values they are used with."""

from claimloom.functions.columns import (
    as_yes_no,
    holds,
    in_any_set,
    numbered_columns,
    starts_with_any,
    with_prefix,
)

__all__ = [
    "as_yes_no",
    "holds",
    "in_any_set",
    "numbered_columns",
    "starts_with_any",
    "with_prefix",
]
