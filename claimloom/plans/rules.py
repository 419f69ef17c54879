"""What the decoration goes by; the defaults are the fixed rules."""

from __future__ import annotations

from dataclasses import dataclass

from claimloom.functions import fixed_values as fixed


SHORT_LOOKBACK = 7


@dataclass(frozen=True)
class Rules:
    """Code sets, line cases and lookback of the decoration.

    Up to ``SHORT_LOOKBACK`` days a signal is written down for each day it covers; for a
    longer lookback each line finds the last signal before it, whatever the number of days.
    """

    emergency_hcpcs: tuple[str, ...] = fixed.EMERGENCY_HCPCS
    emergency_revenue: tuple[str, ...] = fixed.EMERGENCY_REVENUE
    inpatient_only: tuple[str, ...] = fixed.INPATIENT_ONLY_CATEGORIES
    inpatient_case: str = fixed.INPATIENT_CASE
    outpatient_case: str = fixed.OUTPATIENT_CASE
    slot_stem: str = "icdproc"
    lookback_days: int = 1

    def __post_init__(self):
        if self.lookback_days < 0:
            raise ValueError("lookback_days must not be negative")

    @property
    def is_short(self) -> bool:
        return self.lookback_days <= SHORT_LOOKBACK
