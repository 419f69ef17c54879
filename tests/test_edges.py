"""Nulls, ties, gaps and other cases at the edge, through the whole decoration."""

from datetime import date, timedelta

import pytest

from claimloom import decorate
from claimloom.operators import enforce
from claimloom.plans import (
    decoration_report,
    inpatient_candidates,
    keep_allowed_drgs,
    outpatient_candidates,
)
from claimloom.sources import split_codes
from tests.made_claims import CODE_ROWS, DAY, claims, codes, inpatient, line, outpatient


def run(spark, lines, code_rows=CODE_ROWS):
    rows = decorate(claims(spark, lines), split_codes(codes(spark, code_rows))).collect()
    assert len(rows) == len(lines)
    return {
        r["sequencenumber"]: (r["psp_eligible_yn"], r["psp_category"], r["psp_preventable_yn"])
        for r in rows
    }


def test_null_case_ids_are_one_group(spark):
    found = run(
        spark,
        [
            inpatient(1, "0XA1111", caseadmitid=None),
            inpatient(2, "0XA1111", caseadmitid=None, mr_allowed=900),
            inpatient(3, "0XA1111", caseadmitid=None, mr_allowed=None),
        ],
    )
    assert found == {1: ("Y", None, None), 2: ("Y", "ccs61", "Y"), 3: ("Y", None, None)}


def test_null_member_or_day_has_no_signal(spark):
    found = run(
        spark,
        [
            inpatient(1, "0XA1111", member_id=None),
            inpatient(2, "0XA1111", prm_fromdate=None, member="x"),
            outpatient(3, "A1001", member_id=None),
            outpatient(4, "A1001", member_id=None),
            line(5, "O11", member_id=None, hcpcs="99281"),
            line(6, "O11", member="x", prm_fromdate=None, hcpcs="99281"),
        ],
    )
    assert found[1] == found[2] == ("Y", "ccs61", "Y")
    assert found[3] == ("Y", "ccs33", "Y")
    assert found[4] == ("Y", None, None)


def test_other_line_cases_are_not_eligible(spark):
    cases = [None, "i12", "I1", "XI12", ""]
    found = run(spark, [inpatient(n, "0XA1111", mr_line_case=c) for n, c in enumerate(cases)])
    assert set(found.values()) == {("N", None, None)}


def test_line_case_is_a_prefix(spark):
    found = run(spark, [inpatient(1, "0XA1111", mr_line_case="I12b")])
    assert found == {1: ("Y", "ccs61", "Y")}


def test_ends_of_the_lookback(spark):
    far = date(2019, 1, 1)
    lines, expected = [], {}
    for before, flag in [(2, "Y"), (1, "N"), (0, "N"), (-1, "Y")]:
        when = DAY - timedelta(days=before)
        signals = {
            "emergency": {"prm_fromdate": when, "prm_todate": far, "revcode": "0981"},
            "transfer": {
                "prm_fromdate": far,
                "prm_todate": when,
                "prm_acute_transfer_to_acute_yn": "Y",
            },
        }
        for kind, values in signals.items():
            member, n = f"{kind}{before}", len(lines)
            lines += [
                inpatient(n, "0XA1111", member=member),
                outpatient(n + 1, "A1001", member=member),
                line(n + 2, "O11" if kind == "emergency" else None, member=member, **values),
            ]
            expected[n] = ("Y", "ccs61", flag)
            expected[n + 1] = ("Y", "ccs33", flag if kind == "emergency" else "Y")
            expected[n + 2] = ("N", None, None)
    assert run(spark, lines) == expected


def test_surgery_line_may_be_its_own_signal(spark):
    found = run(
        spark,
        [
            inpatient(1, "0XA1111", revcode="0450"),
            outpatient(2, "A1001", revcode="0450"),
            inpatient(3, "0XA1111", prm_todate=DAY, prm_acute_transfer_to_acute_yn="Y"),
        ],
    )
    assert [found[n][2] for n in (1, 2, 3)] == ["N", "N", "N"]


def test_positions_count_empty_slots(spark):
    lines = claims(spark, [inpatient(1, None, "0XA1111", None, "0XA1111", "", "zzz")])
    refs = split_codes(codes(spark))
    rows = inpatient_candidates(lines, refs["icd_procs"]).collect()
    assert sorted((r["position"], r["ccs"]) for r in rows) == [(1, "ccs61"), (3, "ccs61")]


def test_all_slots_empty(spark):
    assert run(spark, [inpatient(1), outpatient(2, None)]) == {
        1: ("Y", None, None),
        2: ("Y", None, None),
    }


def test_lower_slot_wins_over_higher_amount(spark):
    found = run(
        spark,
        [
            inpatient(1, "0XA1111", member="a", mr_allowed=1),
            inpatient(2, "zzz", "0XA1111", member="a", mr_allowed=1000),
        ],
    )
    assert found == {1: ("Y", "ccs61", "Y"), 2: ("Y", None, None)}


def test_drg_filter_comes_before_the_choice(spark):
    found = run(spark, [inpatient(1, "0XB2222", "0XA1111", drg="101")])
    assert found == {1: ("Y", "ccs61", "Y")}


def test_drg_must_be_allowed_for_the_same_category(spark):
    assert run(spark, [inpatient(1, "0XA1111", drg="330")]) == {1: ("Y", None, None)}


def test_excluded_category_leaves_the_day_to_another(spark):
    found = run(
        spark,
        [
            outpatient(1, "A1003", member="a", mr_allowed=1000),
            outpatient(2, "A1002", member="a", mr_allowed=1),
        ],
    )
    assert found == {1: ("Y", None, None), 2: ("Y", "ccs66", "Y")}


def test_outpatient_groups_by_member_and_day_not_case(spark):
    found = run(
        spark,
        [
            outpatient(1, "A1002", member="a", caseadmitid="x"),
            outpatient(2, "A1002", member="a", caseadmitid="y", mr_allowed=600),
            outpatient(3, "A1002", member="a", prm_fromdate=DAY + timedelta(days=1)),
        ],
    )
    assert [found[n][1] for n in (1, 2, 3)] == [None, "ccs66", "ccs66"]


def test_paid_date_comes_before_amount_and_nulls_last(spark):
    found = run(
        spark,
        [
            outpatient(1, "A1002", member="a", mr_allowed=999, paiddate=date(2021, 7, 19)),
            outpatient(2, "A1002", member="a", mr_allowed=1),
            outpatient(3, "A1002", member="a", mr_allowed=999, paiddate=None),
        ],
    )
    assert [found[n][1] for n in (1, 2, 3)] == [None, "ccs66", None]


def test_full_ties_go_to_the_lowest_key(spark):
    found = run(
        spark,
        [
            inpatient(2, "0XA1111", member="a"),
            inpatient(1, "0XA1111", member="a"),
            outpatient(4, "A1002", member="b"),
            outpatient(3, "A1002", member="b"),
        ],
    )
    assert [found[n][1] for n in (1, 2, 3, 4)] == ["ccs61", None, "ccs66", None]


def test_code_of_two_categories_gives_two_candidates_and_one_winner(spark):
    rows = [*CODE_ROWS, ("0XA1111", "ICD10_PROC", "ccs78"), ("A1001", "CPT_HCPCS", "ccs66")]
    refs = split_codes(codes(spark, rows))
    lines = [inpatient(1, "0XA1111"), outpatient(2, "A1001")]
    frame = claims(spark, lines)
    assert inpatient_candidates(frame, refs["icd_procs"]).count() == 2
    assert outpatient_candidates(frame, refs["hcpcs"]).count() == 2
    assert run(spark, lines, rows) == {1: ("Y", "ccs61", "Y"), 2: ("Y", "ccs33", "Y")}


def test_entries_listed_twice_or_with_nulls_do_no_harm(spark):
    extra = [
        ("0XA1111", "ICD10_PROC", None),
        (None, "ICD10_PROC", "ccs61"),
        ("A1001", "CPT_HCPCS", None),
        ("101", "MSDRG", None),
        (None, "MSDRG", "ccs61"),
    ]
    rows = [*CODE_ROWS, *CODE_ROWS, *extra]
    refs = split_codes(codes(spark, rows))
    lines = [inpatient(1, "0XA1111"), outpatient(2, "A1001"), inpatient(3, None, drg=None)]
    frame = claims(spark, lines)
    kept = keep_allowed_drgs(inpatient_candidates(frame, refs["icd_procs"]), refs["drg"])
    assert kept.count() == 1
    assert run(spark, lines, rows) == {
        1: ("Y", "ccs61", "Y"),
        2: ("Y", "ccs33", "Y"),
        3: ("Y", None, None),
    }


def test_empty_claims(spark):
    assert run(spark, []) == {}


def test_repeated_keys_are_reported(spark):
    lines = claims(spark, [inpatient(1, "0XA1111"), inpatient(1, "0XA1111")])
    report = decoration_report(lines, decorate(lines, split_codes(codes(spark))))
    assert report.first()["n_repeated_keys"] == 1
    with pytest.raises(ValueError, match="n_repeated_keys"):
        enforce(report)


def test_null_key_keeps_its_line_without_a_category(spark):
    lines = claims(spark, [inpatient(None, "0XA1111", member="a"), inpatient(1, "0XA1111")])
    rows = decorate(lines, split_codes(codes(spark))).collect()
    assert sorted((r[0] or 0, r[1], r[2]) for r in rows) == [(0, "Y", None), (1, "Y", "ccs61")]


def test_slot_order_is_by_number_not_by_place(spark):
    lines = claims(spark, [inpatient(1, "0XB2222", *[None] * 8, "0XC3333", drg="202")])
    turned = lines.select(*reversed(lines.columns))
    assert decorate(turned, split_codes(codes(spark))).first()["psp_category"] == "ccs152"
