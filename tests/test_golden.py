"""The golden cases, from files to the checked decoration."""

import csv

import pytest

from claimloom import Rules, SurgeryDecorator, decorate
from claimloom.operators import beside, differences, enforce, miss_counts
from claimloom.plans import decoration_report, inpatient_branch, outpatient_branch
from claimloom.sources import (
    CLAIMS,
    CODES,
    read_code_tables,
    read_csv,
    read_parquet,
    split_codes,
)
from tests.made_claims import CODE_ROWS, GOLDEN, claims, codes

KEY = ["sequencenumber"]
RESULT = "sequencenumber long, psp_eligible_yn string, psp_category string, psp_preventable_yn string"


@pytest.fixture(scope="module")
def expected(spark):
    return spark.createDataFrame([(r["sequencenumber"], *e) for r, e in GOLDEN], RESULT)


@pytest.fixture(scope="module")
def decorated(spark):
    lines = claims(spark, [r for r, _ in GOLDEN])
    return decorate(lines, split_codes(codes(spark))).cache()


def test_golden_rows(decorated, expected):
    assert decorated.schema.names == expected.schema.names
    assert differences(expected, decorated, KEY).collect() == []
    assert miss_counts(differences(expected, decorated, KEY), KEY).collect() == []


def test_golden_rows_beside_each_other(decorated, expected):
    rows = beside(expected, decorated, KEY).collect()
    assert len(rows) == len(GOLDEN)
    for r in rows:
        assert r["expected_psp_category"] == r["psp_category"]
        assert r["expected_psp_preventable_yn"] == r["psp_preventable_yn"]


def test_golden_contract(spark, decorated):
    enforce(decoration_report(claims(spark, [r for r, _ in GOLDEN]), decorated))


def test_golden_from_files(spark, tmp_path, expected):
    with open(tmp_path / "outclaims.csv", "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(CLAIMS.names)
        writer.writerows([r[c] for c in CLAIMS.names] for r, _ in GOLDEN)
    for category in {k for _, _, k in CODE_ROWS}:
        with open(tmp_path / f"codes_{category}.csv", "w", newline="") as file:
            writer = csv.writer(file)
            writer.writerow(CODES.names)
            writer.writerows((c, f"x, {c}", t, k) for c, t, k in CODE_ROWS if k == category)
    lines = read_csv(spark, str(tmp_path / "outclaims.csv"), CLAIMS)
    refs = split_codes(read_code_tables(spark, str(tmp_path / "codes_*.csv")))
    result = SurgeryDecorator().calc_decorator(dfs_input={"outclaims": lines}, dfs_refs=refs)
    assert differences(expected, result, KEY).collect() == []


def test_shuffled_code_joins_give_the_same(spark, expected):
    lines = claims(spark, [r for r, _ in GOLDEN])
    refs = split_codes(codes(spark))
    for branch in (inpatient_branch, outpatient_branch):
        forms = [dict.fromkeys(refs, small) for small in (True, False)]
        small, large = (branch(lines, refs, small=form) for form in forms)
        assert sorted(small.collect()) == sorted(large.collect()) != []


def test_other_rules(spark):
    lines = claims(spark, [r for r, _ in GOLDEN])
    rules = Rules(inpatient_only=("ccs33",), emergency_hcpcs=("none",))
    rows = decorate(lines, split_codes(codes(spark)), rules).collect()
    found = {r["sequencenumber"]: (r["psp_category"], r["psp_preventable_yn"]) for r in rows}
    assert found[40] == ("ccs152", "Y")
    assert found[61] == (None, None)
    assert found[31] == ("ccs153", "N")
    assert found[32] == (None, None)


def test_no_inpatient_only_category(spark):
    """A null category stays out even where no category is excluded."""
    lines = claims(spark, [r for r, _ in GOLDEN])
    refs = split_codes(codes(spark, [*CODE_ROWS, ("ZZZZZ", "CPT_HCPCS", None)]))
    rows = decorate(lines, refs, Rules(inpatient_only=())).collect()
    found = {r["sequencenumber"]: (r["psp_category"], r["psp_preventable_yn"]) for r in rows}
    assert found[90] == (None, None)
    assert found[31] == ("ccs153", "N")


def test_repeated_key_is_refused(spark):
    lines = claims(spark, [GOLDEN[0][0], GOLDEN[0][0] | {"caseadmitid": "other"}])
    tables = {"dfs_input": {"outclaims": lines}, "dfs_refs": split_codes(codes(spark))}
    with pytest.raises(ValueError, match="not unique: 31"):
        SurgeryDecorator().calc_decorator(**tables)
    assert SurgeryDecorator().calc_decorator(**tables, check=False).columns


def test_absent_or_mistyped_columns_are_refused(spark, tmp_path):
    lines = claims(spark, [r for r, _ in GOLDEN])
    refs = split_codes(codes(spark))
    odd = lines.drop("prm_acute_transfer_to_acute_yn").withColumnRenamed("hcpcs", "procedure")
    with pytest.raises(ValueError, match="hcpcs .absent.*prm_acute"):
        decorate(odd, refs)
    odd.write.parquet(str(tmp_path / "odd"))
    with pytest.raises(ValueError, match="prm_acute_transfer_to_acute_yn .absent"):
        read_parquet(spark, str(tmp_path / "odd"), CLAIMS)
    typed = lines.withColumn("paiddate", lines["paiddate"].cast("string"))
    with pytest.raises(ValueError, match="paiddate .string, not date"):
        decorate(typed, refs)
    with pytest.raises(ValueError, match="drg: ccs"):
        decorate(lines, refs | {"drg": refs["drg"].drop("ccs")})


def test_broken_file_rows_fail_whatever_is_read(spark, tmp_path):
    """Also where the broken field is in a column that the decoration does not read."""
    head = ",".join(CODES.names)
    (tmp_path / "codes.csv").write_text(f"{head}\n0XA1111,x,ICD10_PROC,ccs61,more\n")
    refs = split_codes(read_code_tables(spark, str(tmp_path / "codes.csv")))
    with pytest.raises(Exception, match="FAILFAST|[Mm]alformed"):
        refs["icd_procs"].select("code", "ccs").collect()
    rows = [GOLDEN[0][0] | {"line_number": "1"}]
    with open(tmp_path / "lines.csv", "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(CLAIMS.names)
        writer.writerows([r[c] for c in CLAIMS.names[:-1]] + ["no date"] for r in rows)
    lines = read_csv(spark, str(tmp_path / "lines.csv"), CLAIMS)
    with pytest.raises(Exception, match="FAILFAST|[Mm]alformed"):
        decorate(lines, split_codes(codes(spark))).collect()
