"""What the physical plan of the decoration must and must not hold."""

import re

import pytest

from claimloom import decorate
from claimloom.plans import Rules, claim_signal_blocks, claim_signals, outpatient_branch
from claimloom.sources import read_parquet, split_codes, write_parquet
from tests.made_claims import GOLDEN, claims, codes


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plan") / "claims")
    write_parquet(claims(spark, [r for r, _ in GOLDEN]), path)
    return read_parquet(spark, path)


@pytest.fixture
def no_small_joins(spark):
    """As at scale: nothing but what the library asks for is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df.collect()
    final = plan_of(df)
    return final[: final.index("Initial Plan")]


def test_decoration(spark, lines, no_small_joins):
    df = decorate(lines, split_codes(codes(spark)))
    plan = plan_of(df)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan
    assert plan.count("WindowGroupLimit") >= 4
    final = executed(df)
    # The signals are computed once and used twice, the choices used once.
    assert final.count("ReusedExchange") == 1
    assert final.count("FileScan parquet") == 5


def test_scans_read_few_columns_and_filter_early(spark, lines, capsys):
    decorate(lines, split_codes(codes(spark))).explain("formatted")
    text = capsys.readouterr().out
    schemas = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert schemas
    for unread in ("claimid", "line_number", "prm_prv_id_operating"):
        assert not any(unread in s for s in schemas)
    assert "StringStartsWith(mr_line_case,I12)" in text
    assert "StringStartsWith(mr_line_case,O12)" in text


def test_signal_tests_reach_the_scan(lines, capsys):
    claim_signals(lines).explain("formatted")
    text = capsys.readouterr().out
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    assert "IsNotNull(member_id)" in pushed
    assert "In(revcode, [0450" in pushed
    assert "EqualTo(prm_acute_transfer_to_acute_yn,Y)" in pushed
    assert plan_of(claim_signals(lines)).count("Exchange") == 1


def test_signals_of_long_lookbacks_are_shuffled_once_whatever_the_days(spark, lines):
    """The rows of signals that are shuffled do not depend on the number of days."""
    blocks = claim_signal_blocks(lines)
    plan = plan_of(blocks)
    assert plan.count("Exchange") == 1
    assert "Generate explode(array(CASE" in plan and "sequence" not in plan

    def signal_rows(days):
        df = decorate(lines, split_codes(codes(spark)), Rules(lookback_days=days))
        return re.findall(r"HashAggregate\(keys=\[member_id#\d+, _block.*", plan_of(df))

    assert len(signal_rows(90)) == len(signal_rows(3650)) > 0


def test_outpatient_flags_need_no_further_shuffle(spark, lines, no_small_joins):
    """One exchange for the choice, one for the signals, none to bring them together."""
    plan = plan_of(outpatient_branch(lines, split_codes(codes(spark)), small={"hcpcs": True}))
    assert len(re.findall(r"Exchange hashpartitioning\((.*?)\)", plan)) == 2
