"""The decoration under several rule sets, for what it costs to do it once.

What the rule sets have in common is computed once: the lines are read once per branch and
once for the signals, whatever the number of rule sets. A candidate carries the choices it
takes part in, one for each different way to choose, and is ranked within each. How long ago the
last signals were is looked up once for each chosen line; every rule set compares it with
its own lookback.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import as_yes_no, holds
from claimloom.operators import (
    add_last_signals,
    attach,
    came_within,
    first_per_group,
    signal_blocks,
)
from claimloom.plans.rules import Rules
from claimloom.plans.surgery import (
    DAY,
    KEY,
    MEMBER,
    RESULT,
    case_order,
    check_inputs,
    code_sizes,
    day_order,
    inpatient_candidates,
    is_eligible,
    is_emergency,
    is_transfer,
    keep_allowed_drgs,
    outpatient_candidates,
)

_CASE = "mr_line_case"
_CHOICE = "_choice"
_BRANCH = "_branch"
_INPATIENT, _OUTPATIENT = 0, 1

FIELDS = RESULT[1:]


def _numbered(rule_sets: Mapping[str, Rules], way: Callable[[Rules], Hashable]) -> dict[str, int]:
    """Number of each rule set's way to choose; equal ways share a number."""
    ways: dict[Hashable, int] = {}
    return {name: ways.setdefault(way(rules), len(ways)) for name, rules in rule_sets.items()}


def _of_each(numbers: Mapping[str, int], rule_sets: Mapping[str, Rules]) -> dict[int, Rules]:
    """One rule set for each number."""
    return {n: rule_sets[name] for name, n in reversed(numbers.items())}


def _per_choice(candidates: DataFrame, takes_part: Mapping[int, Column]) -> DataFrame:
    """Each candidate once for every choice it takes part in."""
    if len(takes_part) == 1:
        ((number, condition),) = takes_part.items()
        return candidates.where(condition).withColumn(_CHOICE, F.lit(number))
    numbers = [F.when(condition, F.lit(n)) for n, condition in takes_part.items()]
    return candidates.withColumn(_CHOICE, F.explode(F.array_compact(F.array(*numbers))))


def _inpatient(lines, refs, rule_sets, numbers, small) -> DataFrame:
    """The chosen inpatient line of each admission, for each way to choose."""
    ways = _of_each(numbers, rule_sets)
    stems = sorted({rules.slot_stem for rules in ways.values()})
    found = []
    for stem in stems:
        own = {n: r for n, r in ways.items() if r.slot_stem == stem}
        candidates = inpatient_candidates(
            lines,
            refs["icd_procs"],
            next(iter(own.values())),
            small["icd_procs"],
            distinct=False,
            cases=sorted({r.inpatient_case for r in own.values()}),
        )
        allowed = keep_allowed_drgs(candidates, refs["drg"], small["drg"])
        part = {n: F.col(_CASE).startswith(r.inpatient_case) for n, r in own.items()}
        found.append(_per_choice(allowed, part))
    rows = reduce(DataFrame.unionByName, found)
    return first_per_group(rows, [_CHOICE, "caseadmitid"], case_order())


def _outpatient(lines, refs, rule_sets, numbers, small) -> DataFrame:
    """The chosen outpatient line of each member's day, for each way to choose."""
    ways = _of_each(numbers, rule_sets)
    candidates = outpatient_candidates(
        lines,
        refs["hcpcs"],
        next(iter(ways.values())),
        small["hcpcs"],
        distinct=False,
        cases=sorted({r.outpatient_case for r in ways.values()}),
    )
    part = {
        n: F.col(_CASE).startswith(r.outpatient_case)
        & F.col("ccs").isNotNull()
        & ~F.col("ccs").isin(list(r.inpatient_only))
        for n, r in ways.items()
    }
    return first_per_group(_per_choice(candidates, part), [_CHOICE, MEMBER, DAY], day_order())


def chosen_under(
    lines: DataFrame,
    refs: Mapping[str, DataFrame],
    rule_sets: Mapping[str, Rules],
    small: Mapping[str, bool] | None = None,
) -> DataFrame:
    """The key and for each rule set, under its name, a struct of category and flag.

    One row for each line that some rule set chose; the struct of one that did not is null.
    """
    if not rule_sets:
        raise ValueError("no rule sets")
    check_inputs(lines, refs)
    small = code_sizes(refs, small)
    inpatient = _numbered(rule_sets, lambda r: (r.inpatient_case, r.slot_stem))
    outpatient = _numbered(rule_sets, lambda r: (r.outpatient_case, r.inpatient_only))
    visits = _numbered(rule_sets, lambda r: (r.emergency_hcpcs, r.emergency_revenue))

    columns = [KEY, MEMBER, DAY, "ccs", _CHOICE]
    chosen = (
        _inpatient(lines, refs, rule_sets, inpatient, small)
        .select(*columns, F.lit(_INPATIENT).alias(_BRANCH))
        .unionByName(
            _outpatient(lines, refs, rule_sets, outpatient, small).select(
                *columns, F.lit(_OUTPATIENT).alias(_BRANCH)
            )
        )
    )
    kinds = {f"visit{n}": (is_emergency(r), DAY) for n, r in _of_each(visits, rule_sets).items()}
    kinds["transfer"] = (is_transfer(), "prm_todate")
    signals = signal_blocks(lines, MEMBER, kinds)
    dated = add_last_signals(chosen, signals, list(kinds), MEMBER, DAY, spread_by=[KEY])

    def result(name: str, rules: Rules) -> Column:
        """The category and flag of a chosen line that this rule set chose."""
        visit = came_within(f"visit{visits[name]}", DAY, rules.lookback_days)
        transfer = came_within("transfer", DAY, rules.lookback_days)
        is_inpatient = F.col(_BRANCH) == _INPATIENT
        number = F.when(is_inpatient, F.lit(inpatient[name])).otherwise(F.lit(outpatient[name]))
        led_to = visit | (is_inpatient & transfer)
        flag = F.when(led_to, F.lit("N")).otherwise(F.lit("Y"))
        return F.when(
            F.col(_CHOICE) == number,
            F.struct(F.col("ccs").alias("psp_category"), flag.alias("psp_preventable_yn")),
        )

    return dated.groupBy(KEY).agg(
        *[F.max(result(name, rules)).alias(name) for name, rules in rule_sets.items()]
    )


def decorate_under(
    lines: DataFrame,
    refs: Mapping[str, DataFrame],
    rule_sets: Mapping[str, Rules],
    small: Mapping[str, bool] | None = None,
) -> DataFrame:
    """One row per line: its key and for each rule set, under its name, a struct of results.

    The structs hold ``FIELDS``, the same values as ``decorate`` gives under that rule set.
    Lines have a unique key, as for ``decorate``.
    """
    per_line = chosen_under(lines, refs, rule_sets, small)
    every = reduce(or_, [holds(is_eligible(rules)) for rules in rule_sets.values()])
    eligible = {n: as_yes_no(is_eligible(r)).alias(f"_eligible_{n}") for n, r in rule_sets.items()}
    flagged = lines.select(KEY, _CASE, *eligible.values())
    met = attach(flagged, per_line, KEY, every)
    return met.select(
        KEY,
        *[
            F.struct(
                F.col(f"_eligible_{name}").alias(FIELDS[0]),
                *[F.col(name)[field].alias(field) for field in FIELDS[1:]],
            ).alias(name)
            for name in rule_sets
        ],
    )


def under(decorated: DataFrame, name: str) -> DataFrame:
    """The plain decoration of one rule set from the result of ``decorate_under``."""
    return decorated.select(KEY, f"{name}.*")
