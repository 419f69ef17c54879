"""The composed decoration of claim lines."""

from claimloom.plans.decorator import LineDecorator, SurgeryDecorator, calc_decorators
from claimloom.plans.rule_sets import decorate_under, under
from claimloom.plans.rules import Rules
from claimloom.plans.surgery import (
    claim_signal_blocks,
    claim_signals,
    decorate,
    decorate_bucketed,
    decoration_checks,
    decoration_report,
    eligible_lines,
    inpatient_branch,
    inpatient_candidates,
    is_emergency,
    keep_allowed_drgs,
    keep_outpatient,
    latest_per_member_day,
    outpatient_branch,
    outpatient_candidates,
    primary_per_case,
    publish_decoration,
    with_preventable,
)

__all__ = [
    "LineDecorator",
    "Rules",
    "SurgeryDecorator",
    "calc_decorators",
    "claim_signal_blocks",
    "claim_signals",
    "decorate",
    "decorate_bucketed",
    "decorate_under",
    "decoration_checks",
    "decoration_report",
    "eligible_lines",
    "inpatient_branch",
    "inpatient_candidates",
    "is_emergency",
    "keep_allowed_drgs",
    "keep_outpatient",
    "latest_per_member_day",
    "outpatient_branch",
    "outpatient_candidates",
    "primary_per_case",
    "publish_decoration",
    "under",
    "with_preventable",
]
