"""Which claim lines are surgeries that could have been treated otherwise.

Inpatient lines are looked up slot by slot, outpatient lines by their one procedure
code. One line per admission, or per member and day, gets the category; it counts as
preventable unless an emergency visit or, for inpatients, an acute transfer came on
its day or shortly before.

The choice of the line does not depend on those signals, so the line is chosen first
and only chosen lines are held against the signals. Columns that the choice needs are
carried along from the scan; nothing is joined back to the claims in between.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions import as_yes_no, in_any_set, numbered_columns, starts_with_any
from claimloom.operators import (
    add_last_signals,
    add_signals,
    attach,
    came_within,
    contract_report,
    first_per_group,
    has_signal,
    keep_pairs,
    lookup,
    may_broadcast,
    signal_blocks,
    signal_days,
    slots_to_rows,
)
from claimloom.plans.rules import Rules
from claimloom.sources import CLAIMS, CODES, BucketedTable, check_columns, publish

KEY = "sequencenumber"
MEMBER = "member_id"
DAY = "prm_fromdate"
KINDS = ("emergency", "transfer")
RESULT = (KEY, "psp_eligible_yn", "psp_category", "psp_preventable_yn")
BRANCH_COLUMNS = (MEMBER, "caseadmitid", KEY, DAY, "ccs", "position", "preventable_yn")

_IDENTITY = (MEMBER, "caseadmitid", KEY, DAY)
_NEEDED = T.StructType(
    [
        CLAIMS[name]
        for name in (
            *_IDENTITY,
            "prm_todate",
            "prm_drg",
            "hcpcs",
            "revcode",
            "mr_line_case",
            "mr_allowed",
            "prm_acute_transfer_to_acute_yn",
            "paiddate",
        )
    ]
)
_INPATIENT_TABLES = ("icd_procs", "drg")
_OUTPATIENT_TABLES = ("hcpcs",)


def _small(
    refs: Mapping[str, DataFrame], names: Sequence[str], small: Mapping[str, bool] | None
) -> Mapping[str, bool]:
    """Which code tables may be broadcast, measured unless it is known."""
    if small is None:
        small = may_broadcast({name: refs[name].select("code", "ccs") for name in names})
    return small


def _entries(codes: DataFrame, distinct: bool) -> DataFrame:
    """Codes and categories; where one candidate is chosen anyway, repeated ones do no harm."""
    entries = codes.select("code", "ccs")
    return entries.distinct() if distinct else entries


def inpatient_candidates(
    lines: DataFrame,
    codes: DataFrame,
    rules: Rules = Rules(),
    small: bool | None = None,
    distinct: bool = True,
    cases: Sequence[str] | None = None,
) -> DataFrame:
    """One row per inpatient line, slot and category of its code.

    ``distinct=False`` spares the shuffle of the code table; an entry that comes repeatedly
    then gives repeated rows. With ``cases`` lines of any of these cases are candidates and
    keep the column that tells them apart.
    """
    surgical = lines.where(
        starts_with_any("mr_line_case", cases or [rules.inpatient_case]) & F.col(KEY).isNotNull()
    )
    rows = slots_to_rows(
        surgical,
        numbered_columns(lines, rules.slot_stem),
        keep=[*_IDENTITY, "prm_drg", "mr_allowed", *(["mr_line_case"] if cases else [])],
        value="icd_proc",
    )
    entries = _entries(codes, distinct)
    found = lookup(rows, entries, on="icd_proc", spread_by=[KEY, "position"], small=small)
    return found.drop("icd_proc")


def outpatient_candidates(
    lines: DataFrame,
    codes: DataFrame,
    rules: Rules = Rules(),
    small: bool | None = None,
    distinct: bool = True,
    cases: Sequence[str] | None = None,
) -> DataFrame:
    """One row per outpatient line and category of its procedure code; see above."""
    surgical = lines.where(
        starts_with_any("mr_line_case", cases or [rules.outpatient_case])
        & F.col(KEY).isNotNull()
    ).select(
        *_IDENTITY, "hcpcs", "paiddate", "mr_allowed", *(["mr_line_case"] if cases else [])
    )
    entries = _entries(codes, distinct)
    found = lookup(surgical, entries, on="hcpcs", spread_by=[KEY], small=small)
    return found.drop("hcpcs").withColumn("position", F.lit(0))


def keep_allowed_drgs(
    candidates: DataFrame, drgs: DataFrame, small: bool | None = None
) -> DataFrame:
    """Candidates whose own line's DRG is allowed for their category."""
    return keep_pairs(
        candidates,
        drgs,
        on={"ccs": "ccs", "prm_drg": "code"},
        spread_by=[KEY, "position"],
        small=small,
    )


def is_emergency(rules: Rules = Rules()) -> Column:
    """Whether a line is an emergency visit by its procedure or its revenue code."""
    return in_any_set({"hcpcs": rules.emergency_hcpcs, "revcode": rules.emergency_revenue})


def claim_signals(lines: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Days covered by an emergency visit or an acute transfer, per member.

    All lines count, whatever their case, the surgery's own line included. A visit is
    dated by the start of its line, a transfer by the end.
    """
    return signal_days(lines, MEMBER, _kinds(rules), rules.lookback_days, day=DAY)


def is_transfer() -> Column:
    """Whether a line is an acute transfer."""
    return F.col("prm_acute_transfer_to_acute_yn") == "Y"


def _kinds(rules: Rules) -> dict[str, tuple[Column, str]]:
    return {"emergency": (is_emergency(rules), DAY), "transfer": (is_transfer(), "prm_todate")}


def claim_signal_blocks(lines: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The same signals as blocks of days, for lookbacks of any length."""
    return signal_blocks(lines, MEMBER, _kinds(rules))


def _signals(lines: DataFrame, rules: Rules) -> DataFrame:
    return claim_signals(lines, rules) if rules.is_short else claim_signal_blocks(lines, rules)


def _flagged(
    chosen: DataFrame, signals: DataFrame, rules: Rules, against: Sequence[str]
) -> DataFrame:
    """Chosen lines with the flag: N where one of the given kinds led to it.

    At most one line of an admission or of a member's day is chosen, so few rows share a
    key and one plain join will do; where some member has very many, Spark splits them.
    """
    if rules.is_short:
        joined = add_signals(chosen, signals, MEMBER, DAY, spread_by=[KEY], unique=True)
        return with_preventable(joined, *against)
    joined = add_last_signals(chosen, signals, KINDS, MEMBER, DAY, spread_by=[KEY])
    led_to = reduce(or_, [came_within(kind, DAY, rules.lookback_days) for kind in against])
    flag = F.when(led_to, F.lit("N")).otherwise(F.lit("Y"))
    return joined.withColumn("preventable_yn", flag)


def with_preventable(df: DataFrame, *against: str) -> DataFrame:
    """Turn signals into the flag: N where one of the given kinds covers the row."""
    flag = F.when(has_signal(KINDS, *against), F.lit("N")).otherwise(F.lit("Y"))
    return df.withColumn("preventable_yn", flag)


def case_order() -> list[Column]:
    return [
        F.col("position").asc_nulls_first(),
        F.col("mr_allowed").desc_nulls_last(),
        F.col(DAY).asc_nulls_first(),
        F.col(KEY).asc_nulls_first(),
        F.col("ccs").asc_nulls_first(),
    ]


def day_order() -> list[Column]:
    return [
        F.col("paiddate").desc_nulls_last(),
        F.col("mr_allowed").desc_nulls_last(),
        F.col(KEY).asc_nulls_first(),
        F.col("ccs").asc_nulls_first(),
    ]


def primary_per_case(candidates: DataFrame) -> DataFrame:
    """One candidate per admission: lowest slot, then highest amount, then earliest."""
    return first_per_group(candidates, by=["caseadmitid"], order=case_order())


def latest_per_member_day(candidates: DataFrame) -> DataFrame:
    """One candidate per member and day: latest paid, then highest amount."""
    return first_per_group(candidates, by=[MEMBER, DAY], order=day_order())


def keep_outpatient(candidates: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Candidates of a category that is not inpatient-only; a null category goes too."""
    excluded = F.col("ccs").isin(list(rules.inpatient_only))
    return candidates.where(F.col("ccs").isNotNull() & ~excluded)


def inpatient_branch(
    lines: DataFrame,
    refs: Mapping[str, DataFrame],
    rules: Rules = Rules(),
    signals: DataFrame | None = None,
    small: Mapping[str, bool] | None = None,
) -> DataFrame:
    """The inpatient lines that get a category, at most one per admission.

    ``small`` says which code tables may be broadcast; left out, they are measured.
    """
    small = _small(refs, _INPATIENT_TABLES, small)
    candidates = inpatient_candidates(
        lines, refs["icd_procs"], rules, small["icd_procs"], distinct=False
    )
    chosen = primary_per_case(keep_allowed_drgs(candidates, refs["drg"], small["drg"]))
    if signals is None:
        signals = _signals(lines, rules)
    flagged = _flagged(chosen, signals, rules, ("transfer", "emergency"))
    return flagged.select(*BRANCH_COLUMNS)


def outpatient_branch(
    lines: DataFrame,
    refs: Mapping[str, DataFrame],
    rules: Rules = Rules(),
    signals: DataFrame | None = None,
    small: Mapping[str, bool] | None = None,
) -> DataFrame:
    """The outpatient lines that get a category, at most one per member and day.

    Inpatient-only categories go before the choice, so another code of that day can win;
    a null category goes with them.
    """
    small = _small(refs, _OUTPATIENT_TABLES, small)
    candidates = outpatient_candidates(
        lines, refs["hcpcs"], rules, small["hcpcs"], distinct=False
    )
    chosen = latest_per_member_day(keep_outpatient(candidates, rules))
    if signals is None:
        signals = _signals(lines, rules)
    return _flagged(chosen, signals, rules, ("emergency",)).select(*BRANCH_COLUMNS)


def is_eligible(rules: Rules = Rules()) -> Column:
    """Whether a line is a surgical one by its case; null is not."""
    return starts_with_any("mr_line_case", [rules.inpatient_case, rules.outpatient_case])


def eligible_lines(lines: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Key, case and eligibility flag of every line."""
    return lines.select(
        KEY, "mr_line_case", as_yes_no(is_eligible(rules)).alias("psp_eligible_yn")
    )


def decorate(
    lines: DataFrame,
    refs: Mapping[str, DataFrame],
    rules: Rules = Rules(),
    small: Mapping[str, bool] | None = None,
) -> DataFrame:
    """One row per line: its key, whether it is eligible, its category, preventable or not.

    ``lines`` has a unique key, which is not checked here, and the columns of claims with
    their types, which is; ``refs`` holds the code tables icd_procs, hcpcs and drg.
    The size of the code tables is measured here, in one small job, unless ``small`` says which
    of them may be broadcast; all else is lazy.
    """
    chosen = chosen_lines(lines, refs, rules, small)
    decorated = attach(eligible_lines(lines, rules), chosen, KEY, is_eligible(rules))
    return decorated.select(*RESULT)


def decorate_bucketed(
    lines: BucketedTable,
    refs: Mapping[str, DataFrame],
    rules: Rules = Rules(),
    small: Mapping[str, bool] | None = None,
) -> DataFrame:
    """The same for claims that are stored in buckets of their key.

    The few chosen lines are shuffled to the buckets of the claims, which stay where they are.
    """
    if lines.key != KEY:
        raise ValueError(f"claims are stored by {lines.key}, not by {KEY}")
    chosen = chosen_lines(lines.rows(), refs, rules, small)
    keyed = attach(eligible_lines(lines.keyed, rules), chosen, KEY, is_eligible(rules))
    # without a key there is nothing to put back
    nothing = [F.lit(None).cast("string").alias(c) for c in RESULT[2:]]
    loose = eligible_lines(lines.loose, rules).select(*RESULT[:2], *nothing)
    return keyed.select(*RESULT).unionByName(loose)


def check_inputs(lines: DataFrame, refs: Mapping[str, DataFrame]) -> None:
    """Raise unless lines and code tables have the columns that a decoration needs."""
    check_columns(lines, _NEEDED, "claims")
    for name in (*_INPATIENT_TABLES, *_OUTPATIENT_TABLES):
        check_columns(refs[name], T.StructType([CODES["code"], CODES["ccs"]]), name)


def code_sizes(
    refs: Mapping[str, DataFrame], small: Mapping[str, bool] | None = None
) -> Mapping[str, bool]:
    """Which of the three code tables may be broadcast, measured in one job unless given."""
    return _small(refs, (*_INPATIENT_TABLES, *_OUTPATIENT_TABLES), small)


def chosen_lines(
    lines: DataFrame,
    refs: Mapping[str, DataFrame],
    rules: Rules = Rules(),
    small: Mapping[str, bool] | None = None,
) -> DataFrame:
    """Key, category and flag of the lines that get a category; see ``decorate``."""
    check_inputs(lines, refs)
    small = code_sizes(refs, small)
    signals = _signals(lines, rules)
    inpatient = inpatient_branch(lines, refs, rules, signals, small)
    outpatient = outpatient_branch(lines, refs, rules, signals, small)
    return inpatient.unionByName(outpatient).select(
        KEY, F.col("ccs").alias("psp_category"), F.col("preventable_yn").alias("psp_preventable_yn")
    )


def decoration_checks(named: Callable[[str], str] = str) -> dict[str, Column]:
    """What must hold for every row of a decoration; ``named`` gives its columns' names."""
    eligible, category, flag = (F.col(named(c)) for c in RESULT[1:])
    return {
        "eligible_value": eligible.isin("Y", "N"),
        "preventable_value": flag.isNull() | flag.isin("Y", "N"),
        "flag_with_category": category.isNull() == flag.isNull(),
        "category_only_if_eligible": category.isNull() | (eligible == "Y"),
    }


def decoration_report(lines: DataFrame, decorated: DataFrame) -> DataFrame:
    """Counts of everything that may be wrong with a decoration; all 0 if it is right."""
    return contract_report(lines, decorated, KEY, must_hold=decoration_checks())


def publish_decoration(lines: DataFrame, decorated: DataFrame, folder: str) -> dict[str, int]:
    """Write a decoration, check it on the way and publish it if it is right.

    One job over the decoration and a scan of the lines' keys; see ``publish``.
    """
    return publish(decorated, folder, decoration_checks(), KEY, same_keys_as=lines)
