"""Hand-made claims and code tables: codes, members, days and amounts made up for these tests."""

from __future__ import annotations

from datetime import date, timedelta

from claimloom.sources import CLAIMS, CODES

DAY = date(2021, 6, 15)

# (code, type, category)
CODE_ROWS = [
    ("0XA1111", "ICD10_PROC", "ccs61"),
    ("0XB2222", "ICD10_PROC", "ccs152"),
    ("0XC3333", "ICD10_PROC", "ccs153"),
    ("0XD4444", "ICD10_PROC", "ccs78"),
    ("0XE5555", "ICD10_PROC", "ccs70"),
    ("0XF6666", "ICD10_PROC", "ccs90"),
    ("0XF7777", "ICD10_PROC", "ccs90"),
    ("A1001", "CPT_HCPCS", "ccs33"),
    ("A1002", "CPT_HCPCS", "ccs66"),
    ("A1003", "CPT_HCPCS", "ccs153"),
    ("A1004", "CPT_HCPCS", "ccs120"),
    ("A1005", "CPT_HCPCS", "ccs137"),
    ("101", "MSDRG", "ccs61"),
    ("202", "MSDRG", "ccs152"),
    ("202", "MSDRG", "ccs153"),
    ("330", "MSDRG", "ccs78"),
    ("477", "MSDRG", "ccs70"),
    ("515", "MSDRG", "ccs90"),
]


def codes(spark, rows=CODE_ROWS):
    return spark.createDataFrame([(c, f"about {c}, {t}", t, k) for c, t, k in rows], CODES)


def line(number, case="I12", **values):
    """A claim line as a dict; anything not given is null or a plain default."""
    slots = values.pop("slots", ())
    member = values.pop("member", f"m{number}")
    made = dict.fromkeys(CLAIMS.names)
    made |= {
        "sequencenumber": number,
        "member_id": member,
        "caseadmitid": f"{member}_1",
        "prm_fromdate": DAY,
        "prm_todate": DAY + timedelta(days=6),
        "mr_line_case": case,
        "mr_allowed": 400,
        "prm_acute_transfer_to_acute_yn": "N",
        "prm_prv_id_operating": "p",
        "paiddate": date(2021, 7, 20),
    }
    made |= {f"icdproc{place}": code for place, code in enumerate(slots, 1)}
    return made | values


def inpatient(number, *slots, drg="101", **values):
    return line(number, "I12", slots=slots, prm_drg=drg, **values)


def outpatient(number, hcpcs, **values):
    return line(number, "O12", hcpcs=hcpcs, **values)


def claims(spark, lines):
    return spark.createDataFrame([tuple(r[c] for c in CLAIMS.names) for r in lines], CLAIMS)


def _before(days):
    return DAY - timedelta(days=days)


# Cases every decoration must get right: a line, then (eligible, category, preventable) as the
# rules have it. Most cases show several rules at once.
GOLDEN = [
    # The dearer code of the day is for inpatients only, so the cheaper one gets the day; its
    # own line is an emergency visit by its revenue code.
    (outpatient(31, "A1003", member="pat", mr_allowed=900), ("Y", None, None)),
    (outpatient(32, "A1002", member="pat", mr_allowed=10, revcode="0456"), ("Y", "ccs66", "N")),
    # The DRG does not go with the first slot's category but with the second's; the visit the
    # day before counts, on a line that is not eligible itself.
    (inpatient(40, "0XD4444", "0XB2222", drg="202", member="eve"), ("Y", "ccs152", "N")),
    (line(41, "O11", member="eve", hcpcs="99285", prm_fromdate=_before(1)), ("N", None, None)),
    # One admission: the lower slot beats the amount, then the earlier day decides. A transfer
    # that ended two days before is too early to count.
    (
        inpatient(51, "0XF6666", drg="515", member="sam", prm_fromdate=DAY + timedelta(days=1)),
        ("Y", None, None),
    ),
    (inpatient(50, "0XF7777", drg="515", member="sam"), ("Y", "ccs90", "Y")),
    (
        inpatient(52, None, "0XF6666", drg="515", member="sam", mr_allowed=7000),
        ("Y", None, None),
    ),
    (
        line(
            53,
            "I11",
            member="sam",
            prm_fromdate=_before(9),
            prm_todate=_before(2),
            prm_acute_transfer_to_acute_yn="Y",
        ),
        ("N", None, None),
    ),
    # A transfer that ended the day before counts for inpatients, not for outpatients.
    (inpatient(60, "0XE5555", drg="477", member="kim"), ("Y", "ccs70", "N")),
    (outpatient(61, "A1001", member="kim"), ("Y", "ccs33", "Y")),
    (
        line(
            62,
            None,
            member="kim",
            prm_fromdate=_before(4),
            prm_todate=_before(1),
            prm_acute_transfer_to_acute_yn="Y",
        ),
        ("N", None, None),
    ),
    # Without a paid date the highest amount loses; of the rest the amount decides.
    (outpatient(70, "A1005", member="lou", mr_allowed=999, paiddate=None), ("Y", None, None)),
    (outpatient(72, "A1005", member="lou", mr_allowed=5), ("Y", "ccs137", "Y")),
    (outpatient(71, "A1005", member="lou", mr_allowed=-5), ("Y", None, None)),
    # No DRG, no category; a longer case, a gap before the slot and no provider do no harm.
    (inpatient(80, "0XA1111", drg=None), ("Y", None, None)),
    (
        inpatient(81, None, "0XA1111", mr_line_case="I12b", prm_prv_id_operating=None),
        ("Y", "ccs61", "Y"),
    ),
    # A code that no table lists.
    (outpatient(90, "ZZZZZ"), ("Y", None, None)),
]
