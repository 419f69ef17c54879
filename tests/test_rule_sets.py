"""Several rule sets in one pass give what each of them gives alone."""

import random
from dataclasses import replace
from datetime import timedelta

import pytest

from claimloom import decorate
from claimloom.operators import differences, field_differences, field_miss_counts, miss_counts
from claimloom.plans import Rules, decorate_under, under
from claimloom.plans.surgery import KEY
from claimloom.sources import read_parquet, split_codes, write_parquet
from tests.made_claims import CODE_ROWS, DAY, GOLDEN, claims, codes, line

SETS = {
    "plain": Rules(),
    "same day": replace(Rules(), lookback_days=0),
    "a year": replace(Rules(), lookback_days=365),
    "fewer": replace(Rules(), inpatient_only=("ccs33",), emergency_hcpcs=("99281",)),
    "other cases": replace(Rules(), inpatient_case="I11", outpatient_case="O11"),
    "mixed cases": replace(Rules(), inpatient_case="I1", emergency_revenue=()),
}


def made_lines(count: int, seed: int = 1) -> list[dict]:
    """Lines of few members, days and admissions, so that much comes together."""
    rng = random.Random(seed)
    icd = [c for c, kind, _ in CODE_ROWS if kind == "ICD10_PROC"]
    cpt = [c for c, kind, _ in CODE_ROWS if kind == "CPT_HCPCS"]
    drgs = [c for c, kind, _ in CODE_ROWS if kind == "MSDRG"]

    def one(number):
        member = rng.choice(["a", "b", "c", "d", None])
        start = rng.choice([None, *[DAY - timedelta(days=rng.randrange(50)) for _ in range(9)]])
        return line(
            number,
            rng.choice(["I12", "I12", "O12", "O12", "I11", "O11", None]),
            member_id=member,
            caseadmitid=rng.choice([None, *[f"{member}{n}" for n in range(6)]]),
            slots=[rng.choice([None, *icd]) for _ in range(3)],
            prm_drg=rng.choice([None, *drgs]),
            hcpcs=rng.choice([None, "99281", "99282", *cpt, *cpt]),
            revcode=rng.choice([None, None, None, "0450", "1"]),
            prm_fromdate=start,
            prm_todate=start and start + timedelta(days=rng.randrange(4)),
            prm_acute_transfer_to_acute_yn=rng.choice(["Y", "N", "N", "N", None]),
            mr_allowed=rng.choice([None, 1, 2, 3]),
        )

    return [one(1000 + n) for n in range(count)]


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sets") / "claims")
    rows = [r for r, _ in GOLDEN] + made_lines(400) + [line(None, "I12")]
    write_parquet(claims(spark, rows), path)
    return read_parquet(spark, path)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("small", [True, False])
def test_each_rule_set_as_alone(spark, lines, small):
    refs = split_codes(codes(spark, CODE_ROWS + CODE_ROWS[:3]))
    sizes = dict.fromkeys(refs, small)
    both = decorate_under(lines, refs, SETS, sizes)
    found = {name: rows_of(under(both, name)) for name in SETS}
    assert found == {name: rows_of(decorate(lines, refs, r, sizes)) for name, r in SETS.items()}
    assert len(set(map(str, found.values()))) == len(SETS)


def test_one_rule_set_is_the_decoration(spark, lines):
    refs = split_codes(codes(spark))
    one = decorate_under(lines, refs, {"it": Rules()})
    assert rows_of(under(one, "it")) == rows_of(decorate(lines, refs))
    with pytest.raises(ValueError, match="no rule sets"):
        decorate_under(lines, refs, {})


def test_differences_in_a_row_are_those_between_tables(spark, lines):
    refs = split_codes(codes(spark))
    keyed = lines.where(f"{KEY} IS NOT NULL")
    both = decorate_under(keyed, refs, {"e": SETS["plain"], "a": SETS["fewer"]}).cache()
    plain = differences(under(both, "e"), under(both, "a"), [KEY])
    assert rows_of(field_differences(both, [KEY], "e", "a")) == rows_of(plain)
    counts = rows_of(field_miss_counts(both, "e", "a"))
    assert counts == rows_of(miss_counts(plain, [KEY])) != []
    assert rows_of(field_miss_counts(both, "e", "e")) == []
    both.unpersist()


def test_scans_do_not_grow_with_the_rule_sets(spark, lines):
    refs = split_codes(codes(spark))
    sizes = dict.fromkeys(refs, True)

    def scans(df):
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString()
        return final[: final.index("Initial Plan")].count("FileScan parquet")

    alone = scans(decorate(lines, refs, small=sizes))
    many = {n: r for n, r in SETS.items() if r.slot_stem == Rules().slot_stem}
    assert scans(decorate_under(lines, refs, many, sizes)) <= alone + 1
