"""Bucketed tables, published results, comparison by digests."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from claimloom import SurgeryDecorator, decorate
from claimloom.demo import catalog
from claimloom.operators import contract_report, differences, differing_blocks
from claimloom.plans import (
    Rules,
    calc_decorators,
    decorate_bucketed,
    decoration_checks,
    decoration_report,
    publish_decoration,
)
from claimloom.plans.surgery import KEY
from claimloom.sources import (
    CODES,
    BrokenResult,
    bad_rows,
    publish,
    read_bucketed,
    read_csv,
    read_manifest,
    read_published,
    remove_unlisted,
    split_codes,
    write_bucketed,
    write_observed,
    written_report,
)
from tests.made_claims import GOLDEN, claims, codes, line


@pytest.fixture
def no_small_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def golden(spark):
    return claims(spark, [r for r, _ in GOLDEN] + [line(None, "I12"), line(None, "O11")])


# Buckets


@pytest.mark.parametrize("buckets", [3, 16])
def test_put_back_leaves_bucketed_claims_where_they_are(spark, tmp_path, no_small_joins, buckets):
    lines = write_bucketed(golden(spark), f"{tmp_path}/claims", KEY, buckets)
    assert rows_of(lines.rows()) == rows_of(golden(spark))
    refs = split_codes(codes(spark))
    sizes = dict.fromkeys(refs, True)
    df = decorate_bucketed(lines, refs, small=sizes)
    assert rows_of(df) == rows_of(decorate(golden(spark), refs, small=sizes))
    plan = plan_of(df)
    # the join on the key is fed by a bucketed scan and no exchange of it
    assert f"SelectedBucketsCount: {buckets} out of {buckets}" in plan
    join = plan[plan.index("SortMergeJoin [sequencenumber") :]
    left = join[: join.index("Exchange")]
    assert "FileScan parquet" in left and "Bucketed: true" in left


def test_two_bucketed_tables_meet_without_any_exchange(spark, tmp_path, no_small_joins):
    left = spark.createDataFrame(
        [(n % 50 or None, n) for n in range(300)], "k long, v long"
    )
    right = spark.createDataFrame([(n, str(n)) for n in range(1, 40)], "k long, w string")
    one = write_bucketed(left, f"{tmp_path}/one", "k", 6)
    two = write_bucketed(right, f"{tmp_path}/two", "k", 6)
    met = one.beside(two)
    assert "Exchange" not in plan_of(met)
    assert rows_of(met) == rows_of(left.join(right, "k", "left"))
    files = [f for f in os.listdir(f"{tmp_path}/one/keyed") if f.startswith("part-")]
    assert len(files) == 6


def test_bucketed_table_outlives_its_session_and_is_whole_or_not_there(spark, tmp_path):
    folder = f"{tmp_path}/t"
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string")
    broken = df.withColumn("v", F.when(F.col("k") == 1, F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        write_bucketed(broken, folder, "k", 2)
    with pytest.raises(ValueError, match="no complete table"):
        read_bucketed(spark, folder)
    write_bucketed(df, f"{folder}2", "k", 2)
    again = read_bucketed(spark.newSession(), f"{folder}2")
    assert rows_of(again.rows()) == [(1, "a"), (None, "b")]
    assert (again.key, again.buckets) == ("k", 2)
    with pytest.raises(ValueError, match="there is a table"):
        write_bucketed(df, f"{folder}2", "k", 2)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed")]
    none = write_bucketed(df.limit(0), f"{tmp_path}/none", "k", 2)
    assert none.rows().columns == ["k", "v"] and none.rows().count() == 0
    with pytest.raises(ValueError, match="kept by"):
        again.beside(write_bucketed(df, f"{tmp_path}/v", "v", 2))


# Published results


def numbers(spark, values):
    return spark.createDataFrame(values, "k long, v string")


def test_published_versions(spark, tmp_path):
    folder = f"{tmp_path}/t"
    with pytest.raises(ValueError, match="nothing published"):
        read_published(spark, folder)
    first = numbers(spark, [(1, "a"), (2, "b"), (None, "c")])
    counts = publish(first, folder, {"v": F.col("v") != "z"}, "k", same_keys_as=first)
    assert counts == {"n": 3, "n_broken_v": 0, "n_null_key_rows": 1}
    second = numbers(spark, [(1, "x")])
    publish(second, folder, {}, "k", partition_by=["v"])
    assert rows_of(read_published(spark, folder)) == [(1, "x")]
    assert rows_of(read_published(spark, folder, 1)) == rows_of(first)
    publish(second.limit(0), folder, {}, "k")
    assert read_published(spark, folder).columns == ["k", "v"]
    assert read_published(spark, folder).count() == 0
    with pytest.raises(ValueError, match="under 7"):
        read_published(spark, folder, 7)


@pytest.mark.parametrize(
    "rows, problem",
    [
        ([(1, "z"), (2, "b")], "n_broken_v"),
        ([(1, None), (2, "b")], "n_broken_v"),
        ([(1, "a")], "other_keys"),
        ([(1, "a"), (1, "a")], "other_keys"),
        ([(1, "a"), (2, "b"), (2, "b")], "other_keys"),
        ([(1, "a"), (3, "b")], "other_keys"),
        ([(1, "a"), (None, "b")], "other_keys"),
    ],
)
def test_broken_result_is_never_published(spark, tmp_path, rows, problem):
    folder = f"{tmp_path}/t"
    right = numbers(spark, [(1, "a"), (2, "b")])
    rules = {"v": F.col("v") != "z"}
    publish(right, folder, rules, "k", same_keys_as=right)
    with pytest.raises(BrokenResult) as raised:
        publish(numbers(spark, rows), folder, rules, "k", same_keys_as=right)
    assert problem in raised.value.counts
    assert rows_of(read_published(spark, folder)) == rows_of(right)
    assert len([f for f in os.listdir(folder) if f.startswith("data-")]) == 1


def test_write_lost_half_way_is_not_seen_and_can_be_repeated(spark, tmp_path):
    """Some tasks have written their files when another fails and ends the job."""
    folder = f"{tmp_path}/t"
    old = numbers(spark, [(1, "old")])
    publish(old, folder, {}, "k")
    new = spark.range(4000).repartition(8).select(
        F.col("id").alias("k"), F.col("id").cast("string").alias("v")
    )
    lost = new.withColumn(
        "v", F.when(F.col("k") == 3999, F.raise_error(F.lit("gone"))).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="gone"):
        publish(lost, folder, {}, "k", same_keys_as=new)
    assert rows_of(read_published(spark, folder)) == [(1, "old")]
    # what a driver leaves that ends before it has written the manifest
    write_observed(new, f"{folder}/data-left", {}, "k")
    assert rows_of(read_published(spark, folder)) == [(1, "old")]
    publish(new, folder, {}, "k", same_keys_as=new)
    assert read_published(spark, folder).count() == 4000
    assert "data-left" not in remove_unlisted(spark, folder, older_than_seconds=3600)
    gone = remove_unlisted(spark, folder, older_than_seconds=-60)
    assert "data-left" in gone
    assert not os.path.exists(f"{folder}/data-left")
    assert read_published(spark, folder).count() == 4000
    assert rows_of(read_published(spark, folder, 1)) == [(1, "old")]


def test_files_beside_the_listed_ones_are_not_read(spark, tmp_path):
    folder = f"{tmp_path}/t"
    publish(numbers(spark, [(1, "a")]), folder, {}, "k")
    data = read_manifest(spark, folder)["folder"]
    numbers(spark, [(9, "late")]).write.mode("append").parquet(f"{folder}/{data}")
    assert rows_of(read_published(spark, folder)) == [(1, "a")]


def test_decoration_is_checked_while_it_is_written(spark, tmp_path):
    lines, refs = golden(spark), split_codes(codes(spark))
    folder = f"{tmp_path}/t"
    counts = SurgeryDecorator().publish_decorator({"outclaims": lines}, refs, folder)
    assert counts["n"] == lines.count()
    assert rows_of(read_published(spark, folder)) == rows_of(decorate(lines, refs))
    wrong = decorate(lines, refs).withColumn("psp_eligible_yn", F.lit("N"))
    with pytest.raises(BrokenResult, match="category_only_if_eligible"):
        publish_decoration(lines, wrong, folder)


@pytest.mark.parametrize("change", ["none", "lost", "twice", "repeated lines"])
def test_written_report_equals_the_contract_report(spark, tmp_path, change):
    lines, refs = golden(spark), split_codes(codes(spark))
    result = decorate(lines, refs)
    if change == "lost":
        result = result.where(f"{KEY} IS NULL OR {KEY} <> 31")
    if change == "twice":
        result = result.union(result.where(f"{KEY} = 31"))
    if change == "repeated lines":
        lines, result = lines.union(lines), result.union(result)
    counts = write_observed(result, f"{tmp_path}/r", decoration_checks(), KEY)
    stored = spark.read.parquet(f"{tmp_path}/r")
    found = written_report(lines, stored, counts, decoration_checks(), KEY)
    assert found.first().asDict() == decoration_report(lines, stored).first().asDict()


# Several decorators


def test_two_decorators_cost_one_put_back(spark, tmp_path, no_small_joins):
    golden(spark).write.parquet(f"{tmp_path}/c")
    lines, refs = spark.read.parquet(f"{tmp_path}/c"), split_codes(codes(spark))
    inputs = {"outclaims": lines}
    other = SurgeryDecorator(Rules(lookback_days=0), prefix="own_")
    both = calc_decorators([SurgeryDecorator(), other], inputs, refs)
    joined = [other.calc_decorator(inputs, refs), SurgeryDecorator().calc_decorator(inputs, refs)]
    assert sorted(both.columns) == sorted([*joined[1].columns, *joined[0].columns[1:]])
    for alone in joined:
        assert rows_of(both.select(alone.columns)) == rows_of(alone)
    plan = plan_of(both)
    # the lines with their flags meet the results of both in one join
    assert len(re.findall(r"Join \[sequencenumber#\d+L\], \[sequencenumber", plan)) == 1
    with pytest.raises(ValueError, match="columns of two decorators: psp_category"):
        calc_decorators([SurgeryDecorator(), SurgeryDecorator()], inputs, refs)
    with pytest.raises(ValueError, match="none at all"):
        calc_decorators([], inputs, refs)


def scans_of(df):
    df.collect()
    final = plan_of(df)
    return final[: final.index("Initial Plan")].count("FileScan parquet")


class OwnChoice(SurgeryDecorator):
    """Chooses only lines that get one category."""

    def _chosen(self, dfs_input, dfs_refs):
        chosen = super()._chosen(dfs_input, dfs_refs)
        return chosen.where(F.col(self._named("psp_category")) == "ccs66")


def test_decorators_of_one_kind_read_the_lines_once(spark, tmp_path, no_small_joins):
    golden(spark).write.parquet(f"{tmp_path}/c")
    inputs = {"outclaims": spark.read.parquet(f"{tmp_path}/c")}
    refs = split_codes(codes(spark))
    rules = [Rules(), Rules(lookback_days=90), Rules(inpatient_only=("ccs33",))]
    many = [SurgeryDecorator(r, prefix=f"own{n}_") for n, r in enumerate(rules)]
    both = calc_decorators(many, inputs, refs)
    for decorator in many:
        alone = decorator.calc_decorator(inputs, refs)
        assert rows_of(both.select(alone.columns)) == rows_of(alone)
    assert scans_of(both) <= scans_of(calc_decorators(many[:1], inputs, refs)) + 1


def test_decorators_of_several_kinds_keep_their_own_choice(spark):
    inputs, refs = {"outclaims": golden(spark)}, split_codes(codes(spark))
    plain, longer = SurgeryDecorator(), SurgeryDecorator(Rules(lookback_days=90), "long_")
    own, other = OwnChoice(prefix="own_"), OwnChoice(Rules(lookback_days=0), "other_")
    found = calc_decorators([plain, own, longer, other], inputs, refs)
    alone = [d.calc_decorator(inputs, refs) for d in (plain, longer)]
    alone += [calc_decorators([d], inputs, refs) for d in (own, other)]
    for one in alone:
        assert rows_of(found.select(one.columns)) == rows_of(one)
    named = {r["own_category"] for r in found.collect()}
    assert named == {None, "ccs66"}


def test_two_decorators_query_derives_its_claims_once(spark):
    query = catalog.queries()["two_decorators"](spark, "/root/testdata/sf0.001")
    assert "lineitem.parquet" not in plan_of(query)


# Rows that do not fit


def test_bad_rows_are_named_with_their_file_and_reason(spark, tmp_path):
    schema = "n long, day date, name string"
    fields = spark.createDataFrame([], schema).schema
    (tmp_path / "a.csv").write_text(
        "n,day,name\n1,2020-01-02,x\nx1,2020-01-02,y\n3,2020-01-04\n"
        '4,soon,\n5,2020-01-05,"a, b"\n6,2020-01-06,c,d\n,,\nz,later,\n,2020-01-08\n'
    )
    (tmp_path / "b.csv").write_text("n,day,name\n7,2020-01-07,fine\n")
    found = bad_rows(spark, str(tmp_path), fields).collect()
    assert {(r["row"], r["reason"]) for r in found} == {
        ("x1,2020-01-02,y", "n: x1 is no bigint"),
        ("3,2020-01-04", "2 fields, not 3"),
        ("4,soon,", "day: soon is no date"),
        ("6,2020-01-06,c,d", "more than 3 fields"),
        (",2020-01-08", "2 fields, not 3"),
        ("z,later,", "n: z is no bigint; day: later is no date"),
    }
    assert all(r["path"].endswith("/a.csv") for r in found)
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        read_csv(spark, str(tmp_path), fields).collect()
    assert bad_rows(spark, f"{tmp_path}/b.csv", fields).collect() == []


def test_blank_before_a_quote_is_bad_only_where_blanks_count(spark, tmp_path):
    row = 'A1, "knee, both sides",CPT_HCPCS,ccs149'
    (tmp_path / "c.csv").write_text(f"code,code_description,code_type,ccs\n{row}\n")
    path = f"{tmp_path}/c.csv"
    assert bad_rows(spark, path, CODES).collect() == []
    assert read_csv(spark, path, CODES).first()["code_description"] == "knee, both sides"
    (found,) = bad_rows(spark, path, CODES, skip_blanks=False).collect()
    assert found["row"] == row and found["path"].endswith("/c.csv")
    assert found["reason"] == "more than 4 fields"
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        read_csv(spark, path, CODES, skip_blanks=False).collect()


# Comparison by digests


def test_equal_tables_shuffle_digests_only(spark, tmp_path):
    """A third of the rows has no key; rows repeat; the order is another."""
    rows = [(n % 7 if n % 3 else None, n % 11, str(n % 5)) for n in range(3000)]
    schema = "k long, a long, b string"
    one = spark.createDataFrame(rows, schema).repartition(3)
    two = spark.createDataFrame(rows[::-1], schema).repartition(5)
    for name, df in (("one", one), ("two", two)):
        df.write.parquet(f"{tmp_path}/{name}")
    one, two = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("one", "two"))
    assert differing_blocks(one, two, one.columns).count() == 0
    found = differences(one, two, ["k"])
    assert found.collect() == []
    final = plan_of(found)
    final = final[: final.index("Initial Plan")]
    # with no block that differs, Spark leaves out all the rest
    assert "a#" not in "".join(l for l in final.splitlines() if "hashpartitioning" in l)


@pytest.mark.parametrize("blocks", [1, 3, 1 << 14])
def test_differences_by_blocks_equal_counting_all_rows(spark, blocks):
    rng = random.Random(blocks)

    def table(changes):
        rows = [(n % 40 if n % 3 else None, n % 6, "x" * (n % 3) or None) for n in range(600)]
        for n in rng.sample(range(600), changes):
            rows[n] = rng.choice([(rows[n][0], None, rows[n][2]), (None, 9, "new")])
        return rows

    mine, theirs = table(0), table(25)
    schema = "k long, a long, b string"
    found = differences(*(spark.createDataFrame(t, schema) for t in (mine, theirs)), ["k"], blocks)

    def counted(items):
        out = {}
        for side, key in items:
            out.setdefault(key, [0, 0])[side] += 1
        return {key: n for key, n in out.items() if n[0] != n[1]}

    left = counted([(0, r) for r in mine] + [(1, r) for r in theirs])
    cells = {}
    for (k, a, b), n in left.items():
        for column, value in (("a", a), ("b", b)):
            cell = cells.setdefault((k, column, None if value is None else str(value)), [0, 0])
            cell[0] += n[0]
            cell[1] += n[1]
    meant = [(*key, *n) for key, n in cells.items() if n[0] != n[1]]
    assert rows_of(found) == sorted(meant, key=str)


def test_nulls_and_their_places_make_different_digests(spark):
    one = spark.createDataFrame([(None, "a", 1), ("b", None, 2)], "a string, b string, k long")
    two = spark.createDataFrame([("a", None, 1), (None, "b", 2)], "a string, b string, k long")
    assert differing_blocks(one, two, ["k"]).count() == 2
    empty = one.limit(0)
    assert differing_blocks(empty, empty, ["k"]).count() == 0
    assert differences(empty, one, ["k"]).count() == 4
    assert contract_report(one, two, "k", {}).first()["n_missing_keys"] == 0
