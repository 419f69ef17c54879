"""The operators one by one, the joins against brute force."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from claimloom.functions import as_yes_no, holds, in_any_set, numbered_columns, with_prefix
from claimloom.operators import (
    add_last_signals,
    add_signals,
    attach,
    beside,
    came_within,
    check_names,
    code_conflicts,
    code_coverage,
    contract_report,
    differences,
    enforce,
    first_per_group,
    fits_broadcast,
    has_signal,
    keep_pairs,
    lookup,
    may_broadcast,
    miss_counts,
    signal_blocks,
    signal_days,
    slots_to_rows,
    spread_join,
)
from claimloom.plans import LineDecorator, SurgeryDecorator
from claimloom.sources import CODE_TYPES
from tests.made_claims import codes

START = date(2020, 1, 1)


def test_in_any_set(spark):
    df = spark.createDataFrame(
        [("a", None), (None, "b"), (None, None), ("x", "y")], "h string, r string"
    )
    test = in_any_set({"h": ["a"], "r": ["b"]})
    rows = df.select(as_yes_no(test).alias("f"), holds(~holds(test)).alias("n")).collect()
    assert [(r["f"], r["n"]) for r in rows] == [("Y", False), ("Y", False), ("N", True), ("N", True)]


def test_numbered_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "p10 int, p2 int, p int, p1 int, p2x int")
    assert numbered_columns(df, "p") == ["p1", "p2", "p10"]


def test_with_prefix(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    assert with_prefix(df, "expected_", keep=["k"]).columns == ["k", "expected_v"]


def test_fits_broadcast(spark):
    df = spark.range(1000).select(F.repeat(F.lit("x"), 100).alias("s"))
    assert fits_broadcast(df)
    assert fits_broadcast(df, max_bytes=1000 * 164)
    assert not fits_broadcast(df, max_bytes=1000 * 164 - 1)
    assert not fits_broadcast(df, df, max_bytes=1000 * 164)
    assert fits_broadcast(df.limit(0), max_bytes=0)


def _skewed(spark, n=400):
    """Rows of which many share one key, some have none, and some match nothing."""
    rng = random.Random(7)
    keys = [rng.choice([1, 1, 1, 1, 2, 3, 4, 50, None]) for _ in range(n)]
    return spark.createDataFrame(list(enumerate(keys)), "id int, k int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("hot_rows", [1, 7, 40, 10_000])
def test_spread_join_equals_plain_join(spark, how, hot_rows):
    df = _skewed(spark)
    table = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "c"), (2, "c"), (9, "d"), (None, "e")], "k int, v string"
    )
    plain = df.join(table, ["k"], how)
    spread = spread_join(df, table, ["k"], how, spread_by=["id"], hot_rows=hot_rows)
    assert spread.columns == plain.columns
    assert differences(plain, spread, ["id"]).count() == 0
    assert spread.count() == plain.count()


def test_spread_join_splits_the_hot_key(spark):
    """No task of the join holds more than a part of the hot key."""
    df = spark.range(4000).select("id", F.lit(1).alias("k"))
    table = spark.createDataFrame([(1, "a")], "k int, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = spread_join(df, table, ["k"], "inner", spread_by=["id"], hot_rows=100)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 4000
    assert max(sizes) < 1200


def test_spread_join_refuses_other_kinds(spark):
    with pytest.raises(ValueError, match="full"):
        spread_join(_skewed(spark), _skewed(spark), ["k"], "full", spread_by=["id"])


@pytest.mark.parametrize("small", [True, False, None])
def test_lookup(spark, small):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z")], "id int, c string")
    table = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("b", "x"), (None, "x")], "code string, ccs string"
    )
    found = lookup(df, table, on="c", small=small)
    assert found.columns == ["id", "c", "ccs"]
    assert sorted(map(tuple, found.collect())) == [(1, "a", "x"), (1, "a", "y"), (2, "b", "x")]


@pytest.mark.parametrize("small", [True, False, None])
def test_keep_pairs(spark, small):
    rows = [(1, "a", "1"), (2, "a", "2"), (3, None, "1"), (4, "a", None)]
    df = spark.createDataFrame(rows, "id int, c string, d string")
    pairs = spark.createDataFrame(
        [("a", "1"), ("a", "1"), (None, "1"), ("a", None), ("b", "2")], "cat string, drg string"
    )
    kept = keep_pairs(df, pairs, {"c": "cat", "d": "drg"}, small=small)
    assert kept.columns == df.columns
    assert [tuple(r) for r in kept.collect()] == [(1, "a", "1")]


def test_first_per_group(spark):
    rows = [(1, "g", 5), (2, "g", 9), (3, None, 1), (4, None, 2), (5, "h", None)]
    df = spark.createDataFrame(rows, "id int, g string, v int")
    best = first_per_group(df, ["g"], [F.col("v").desc_nulls_last(), F.col("id").asc()])
    assert best.columns == df.columns
    assert sorted(r["id"] for r in best.collect()) == [2, 4, 5]


def _events(seed, n, spread):
    rng = random.Random(seed)

    def row(i):
        member = rng.choice(["a", "a", "a", "b", "c", None])
        day = rng.choice([None, *[START + timedelta(days=d) for d in range(spread)]])
        return (i, member, day, rng.choice(["red", "blue", "none"]))

    return [row(i) for i in range(n)]


@pytest.mark.parametrize("days", [0, 1, 4])
@pytest.mark.parametrize("hot_rows", [2, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_signals_equal_brute_force(spark, days, hot_rows, seed):
    schema = "id int, m string, day date, kind string"
    asked, signals = _events(seed, 120, 30), _events(seed + 100, 40, 30)
    kinds = {k: (F.col("kind") == k, "day") for k in ("red", "blue")}
    covered = signal_days(spark.createDataFrame(signals, schema), "m", kinds, days)
    assert covered.groupBy("m", "day").count().where("count > 1").count() == 0
    found = add_signals(
        spark.createDataFrame(asked, schema), covered, "m", "day", ["id"], hot_rows=hot_rows
    )
    rows = found.select(
        "id", *[as_yes_no(has_signal(list(kinds), k)).alias(k) for k in kinds],
        has_signal(list(kinds), "red", "blue").alias("either"),
    ).collect()
    got = {r["id"]: (r["red"], r["blue"]) for r in rows}

    def hit(member, day, kind):
        return "Y" if any(
            m is not None and m == member and d and day and kind == k
            and timedelta(0) <= day - d <= timedelta(days=days)
            for _, m, d, k in signals
        ) else "N"

    assert len(rows) == len(asked)
    assert got == {i: (hit(m, d, "red"), hit(m, d, "blue")) for i, m, d, _ in asked}
    assert all(r["either"] == ("Y" in (r["red"], r["blue"])) for r in rows)


def test_signals_for_unique_rows_are_the_same(spark):
    schema = "id int, m string, day date, kind string"
    kinds = {"red": (F.col("kind") == "red", "day")}
    signals = spark.createDataFrame(_events(5, 60, 20), schema)
    covered = signal_days(signals, "m", kinds, 2)
    asked = first_per_group(
        spark.createDataFrame(_events(6, 200, 25), schema), ["m", "day"], [F.col("id").asc()]
    )
    one, other = (
        add_signals(asked, covered, "m", "day", ["id"], unique=u) for u in (True, False)
    )
    assert differences(one, other, ["id"]).count() == 0


@pytest.mark.parametrize("hot_rows", [3, 10_000])
@pytest.mark.parametrize("spread", [3, 40, 400])
def test_last_signals_equal_brute_force(spark, spread, hot_rows):
    """Days on both sides of block borders and of 1970, nulls, hot keys split."""
    schema = "id int, m string, day date, kind string"
    moved = timedelta(days=18_350)  # START is then some days before 1970-02-01

    def events(seed, n):
        return [
            (i, m, d and d - moved, k) for i, m, d, k in _events(seed, n, spread)
        ]

    asked, signals = events(spread, 200), events(spread + 1, 60)
    kinds = {k: (F.col("kind") == k, "day") for k in ("red", "blue")}
    blocks = signal_blocks(spark.createDataFrame(signals, schema), "m", kinds)
    assert blocks.groupBy("m", "_block").count().where("count > 1").count() == 0
    found = add_last_signals(
        spark.createDataFrame(asked, schema), blocks, list(kinds), "m", "day", ["id"], hot_rows
    )
    rows = found.select("*", came_within("red", "day", 45).alias("near")).collect()

    def last(member, day, kind):
        days = [
            d for _, m, d, k in signals
            if m is not None and m == member and d and day and kind == k and d <= day
        ]
        return max(days, default=None)

    assert {r["id"]: (r["last_red"], r["last_blue"]) for r in rows} == {
        i: (last(m, d, "red"), last(m, d, "blue")) for i, m, d, _ in asked
    }
    assert len(rows) == len(asked)
    for r in rows:
        assert r["near"] == (r["last_red"] is not None and (r["day"] - r["last_red"]).days <= 45)


def test_signal_days_refuses_negative_days(spark):
    with pytest.raises(ValueError, match="negative"):
        signal_days(_skewed(spark), "k", {"a": (F.lit(True), "day")}, -1)


def test_attach(spark):
    lines = spark.createDataFrame(
        [(1, "in"), (2, "in"), (3, "out"), (4, None), (None, "in")], "id int, c string"
    )
    result = spark.createDataFrame([(1, "x")], "id int, v string")
    rows = attach(lines, result, "id", F.col("c") == "in").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(1, "in", "x"), (2, "in", None), (3, "out", None), (4, None, None), (None, "in", None)],
        key=str,
    )


def test_differences_are_null_safe(spark):
    expected = spark.createDataFrame(
        [(1, "a", "x"), (2, None, "x"), (3, "c", "x"), (4, "d", None)],
        "id int, v string, w string",
    )
    actual = spark.createDataFrame(
        [(1, "a", "x"), (2, "b", "x"), (3, None, "x"), (5, "e", None)],
        "id int, v string, w string",
    )
    found = differences(expected, actual, ["id"])
    assert {(r["id"], r["column"]) for r in found.collect()} == {
        (2, "v"), (3, "v"), (4, "v"), (4, "w"), (5, "v"), (5, "w"),
    }
    assert {r["column"]: r["n_misses"] for r in miss_counts(found, ["id"]).collect()} == {
        "v": 4, "w": 2,
    }


def test_differences_count_repeated_rows(spark):
    one = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "id int, v string")
    two = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    rows = differences(one, two, ["id"]).collect()
    assert [(r["id"], r["value"], r["n_expected"], r["n_actual"]) for r in rows] == [(1, "a", 2, 1)]
    with pytest.raises(ValueError, match="columns or types of: v"):
        differences(one, two.drop("v"), ["id"])


def test_beside_keeps_rows_without_partner(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    two = spark.createDataFrame([(1, "c")], "id int, v string")
    rows = sorted(beside(one, two, ["id"]).collect())
    assert [r.asDict() for r in rows] == [
        {"id": 1, "expected_v": "a", "v": "c"},
        {"id": 2, "expected_v": "b", "v": None},
    ]


def test_contract_report(spark):
    lines = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "id int")
    result = spark.createDataFrame(
        [(1, "Y"), (2, "Z"), (2, None), (4, "N"), (None, "Y")], "id int, f string"
    )
    report = contract_report(lines, result, "id", {"f": F.col("f").isin("Y", "N")})
    assert report.first().asDict() == {
        "n_lines": 5,
        "n_result": 5,
        "n_null_key_rows": 2,
        "n_repeated_keys": 2,
        "n_missing_keys": 1,
        "n_extra_keys": 1,
        "n_broken_f": 2,
    }
    with pytest.raises(ValueError, match="n_missing_keys"):
        enforce(report)


def test_contract_holds_for_equal_sides(spark):
    lines = spark.createDataFrame([(1,), (2,)], "id int")
    enforce(contract_report(lines, lines, "id", {"id": F.col("id") > 0}))
    enforce(contract_report(lines.limit(0), lines.limit(0), "id", {}))
    with pytest.raises(ValueError, match="n_result"):
        enforce(contract_report(lines, lines.limit(1), "id", {}))


def test_column_names_are_checked(spark):
    rule = SurgeryDecorator.validate_decor_column_name
    assert rule("psp_x")
    assert not rule("ccs_x")
    good = spark.createDataFrame([(1, "Y")], "sequencenumber long, psp_a string")
    check_names(good, ["sequencenumber"], rule)
    with pytest.raises(ValueError, match="key"):
        check_names(good.drop("sequencenumber"), ["sequencenumber"], rule)

    class Wrong(SurgeryDecorator):
        def _calc_decorator(self, dfs_input, dfs_refs, **kwargs):
            return good.withColumnRenamed("psp_a", "ccs_a")

    with pytest.raises(ValueError, match="ccs_a"):
        Wrong().calc_decorator({}, {}, check=False)
    with pytest.raises(NotImplementedError):
        LineDecorator().calc_decorator({}, {})


def test_code_reports(spark):
    table = codes(spark)
    conflicts = code_conflicts(table).collect()
    assert [tuple(r) for r in conflicts] == [("MSDRG", "202", 2, "ccs152", "ccs153")]
    rows = code_coverage(table, CODE_TYPES, ["ccs158", "ccs61"]).collect()
    found = {r["ccs"]: (r["n_icd_procs"], r["n_hcpcs"], r["n_drg"], r["missing"]) for r in rows}
    assert found["ccs61"] == (1, 0, 1, "hcpcs")
    assert found["ccs153"] == (1, 1, 1, "")
    assert found["ccs158"] == (0, 0, 0, "icd_procs,hcpcs,drg")
    assert code_coverage(table, CODE_TYPES).where("ccs = 'ccs158'").count() == 0


def test_differences_compare_types_and_key_only_tables(spark):
    text = spark.createDataFrame([(1, "1")], "k long, v string")
    number = spark.createDataFrame([(1, 1)], "k long, v int")
    with pytest.raises(ValueError, match="types of: v"):
        differences(text, number, ["k"])
    rows = differences(text.select("k"), spark.createDataFrame([(2,)], "k long"), ["k"]).collect()
    assert sorted(tuple(r) for r in rows) == [(1, None, None, 1, 0), (2, None, None, 0, 1)]


def test_beside_keeps_rows_without_a_key(spark):
    mine = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "k long, v string")
    other = spark.createDataFrame([(1, "x"), (None, "y")], "k long, v string")
    rows = sorted(tuple(r) for r in beside(mine, other, ["k"]).collect() if r["k"] is None)
    assert rows == [(None, "b", None), (None, "c", None)]
    assert beside(mine, other, ["k"]).count() == 3


def test_no_slot_columns(spark):
    with pytest.raises(ValueError, match="slot"):
        slots_to_rows(spark.range(1), [], keep=["id"])


def test_list_of_split_keys_is_bounded(spark):
    """More hot keys than may be sent: the hottest are split, the rest join whole."""
    left = spark.createDataFrame(
        [(k, n) for k in range(30) for n in range(5 + k)], "k long, n long"
    )
    right = spark.createDataFrame([(k, -k) for k in range(30)], "k long, v long")
    found = spread_join(left, right, ["k"], "inner", ["n"], hot_rows=2, hot_keys=4)
    meant = left.join(right, "k").select(*found.columns)
    assert sorted(found.collect()) == sorted(meant.collect())
    assert "LocalLimit 4" in found._jdf.queryExecution().optimizedPlan().toString()


def test_smallest_tables_are_broadcast_while_their_sum_fits(spark):
    small, large = spark.range(10), spark.range(1000)
    one = 10 * (64 + 16)
    assert may_broadcast({"s": small, "l": large}, max_bytes=one) == {"s": True, "l": False}
    assert may_broadcast({"a": small, "b": small}, max_bytes=2 * one - 1) == {
        "a": True,
        "b": False,
    }
