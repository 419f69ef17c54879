"""Relational steps, each DataFrame in, DataFrame out."""

from claimloom.operators.attach import attach
from claimloom.operators.code_reports import code_conflicts, code_coverage
from claimloom.operators.contract import check_names, contract_report, enforce, require_unique
from claimloom.operators.diff import (
    beside,
    differences,
    differing_blocks,
    field_differences,
    field_miss_counts,
    miss_counts,
)
from claimloom.operators.lookback import (
    add_last_signals,
    add_signals,
    came_within,
    has_signal,
    signal_blocks,
    signal_days,
)
from claimloom.operators.lookup import keep_pairs, lookup
from claimloom.operators.pick import first_per_group
from claimloom.operators.sizing import fits_broadcast, key_counts, may_broadcast, spread_join
from claimloom.operators.slots import slots_to_rows

__all__ = [
    "add_last_signals",
    "add_signals",
    "attach",
    "beside",
    "came_within",
    "check_names",
    "code_conflicts",
    "code_coverage",
    "contract_report",
    "differences",
    "differing_blocks",
    "enforce",
    "field_differences",
    "field_miss_counts",
    "first_per_group",
    "fits_broadcast",
    "has_signal",
    "keep_pairs",
    "key_counts",
    "lookup",
    "may_broadcast",
    "miss_counts",
    "require_unique",
    "signal_blocks",
    "signal_days",
    "slots_to_rows",
    "spread_join",
]
