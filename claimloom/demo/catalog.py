"""The registered queries, one per operator, over the derived claims."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.demo.tables import claims, code_table, code_tables, table
from claimloom.functions import as_yes_no, numbered_columns
from claimloom.operators import (
    add_last_signals,
    add_signals,
    beside,
    came_within,
    code_conflicts,
    code_coverage,
    contract_report,
    differences,
    field_differences,
    field_miss_counts,
    has_signal,
    lookup,
    miss_counts,
    signal_blocks,
    signal_days,
    slots_to_rows,
)
from claimloom.plans import (
    Rules,
    SurgeryDecorator,
    calc_decorators,
    claim_signals,
    decorate,
    decorate_bucketed,
    decorate_under,
    decoration_checks,
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
from claimloom.plans.surgery import DAY, KEY, KINDS, MEMBER, RESULT
from claimloom.sources import (
    CLAIMS,
    CODE_TYPES,
    CODES,
    bad_rows,
    new_shared_folder,
    read_code_tables,
    read_folder,
    read_parquet,
    read_published,
    split_codes,
    tables_in,
    write_bucketed,
    write_csv,
    write_observed,
    write_parquet,
    written_report,
)

Query = Callable[[SparkSession, str], DataFrame]

# Dates and amounts among the columns of claims.
MAY_BE_NULL = tuple(
    f.name for f in CLAIMS if isinstance(f.dataType, T.DateType) or f.name == "mr_allowed"
)
RULES = Rules()
NO_LOOKBACK = replace(RULES, lookback_days=0, inpatient_only=("ccs111",))
LONG_LOOKBACK = replace(RULES, lookback_days=90)
BUCKETS = 8  # of the small tables here
NAMED_CATEGORIES = (*RULES.inpatient_only, "ccs44")

_QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    """Put a query in the catalog under its name.

    Dates and amounts of claims, which may be null, are shown as text: clients differ in how
    they show a null among them. Days of signals are never null and shown as timestamps,
    which all clients show alike.
    """

    def shown(field: T.StructField) -> Column:
        if field.name in MAY_BE_NULL:
            return F.col(field.name).cast("string").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("timestamp").alias(field.name)
        return F.col(field.name)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        return df.select(*[shown(f) for f in df.schema])

    _QUERIES[query.__name__] = run
    return query


def queries() -> dict[str, Query]:
    """All registered queries by name."""
    return dict(_QUERIES)


# Claims and flags


@registered
def claims_view(spark, sf_dir):
    """Every claim line with all its columns."""
    return claims(spark, sf_dir)


@registered
def eligible_flag(spark, sf_dir):
    """Eligibility of every line by its case."""
    return eligible_lines(claims(spark, sf_dir), RULES)


@registered
def emergency_marker(spark, sf_dir):
    """Whether each line is an emergency visit by one of its two codes."""
    return claims(spark, sf_dir).select(KEY, as_yes_no(is_emergency()).alias("emergency_yn"))


@registered
def procedure_slots_long(spark, sf_dir):
    """Filled procedure slots of all lines as rows."""
    lines = claims(spark, sf_dir)
    return slots_to_rows(lines, numbered_columns(lines, "icdproc"), keep=[KEY], value="icd_proc")


# Candidates


def _inpatient(spark, sf_dir):
    return inpatient_candidates(claims(spark, sf_dir), code_tables(spark, sf_dir)["icd_procs"])


def _outpatient(spark, sf_dir):
    return outpatient_candidates(claims(spark, sf_dir), code_tables(spark, sf_dir)["hcpcs"])


def _allowed_inpatient(spark, sf_dir):
    return keep_allowed_drgs(_inpatient(spark, sf_dir), code_tables(spark, sf_dir)["drg"])


def _allowed_outpatient(spark, sf_dir):
    return keep_outpatient(_outpatient(spark, sf_dir), RULES)


@registered
def inpatient_candidates_by_slot(spark, sf_dir):
    """Inpatient lines and slots with a category."""
    return _inpatient(spark, sf_dir)


@registered
def outpatient_candidates_by_code(spark, sf_dir):
    """Outpatient lines with a category."""
    return _outpatient(spark, sf_dir)


@registered
def drg_pair_filter(spark, sf_dir):
    """Inpatient candidates whose DRG is allowed for the category."""
    return _allowed_inpatient(spark, sf_dir)


@registered
def outpatient_exclusion(spark, sf_dir):
    """Outpatient candidates without the inpatient-only categories."""
    return _allowed_outpatient(spark, sf_dir)


@registered
def lookup_measured(spark, sf_dir):
    """Category of every item's part; the size of part decides how the join is done."""
    return _item_categories(spark, sf_dir, small=None)


@registered
def lookup_spread(spark, sf_dir):
    """The same with part taken as too large to broadcast, hot parts spread."""
    return _item_categories(spark, sf_dir, small=False)


def _item_categories(spark, sf_dir, small):
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("code"), F.col("p_type").alias("ccs")
    )
    spread_by = ["l_orderkey", "l_linenumber"]
    return lookup(items, parts, on="l_partkey", spread_by=spread_by, small=small)


# Signals


def _days(spark, sf_dir, kind):
    covered = claim_signals(claims(spark, sf_dir), replace(RULES, lookback_days=0))
    return covered.where(has_signal(KINDS, kind)).select(MEMBER, F.col(DAY).alias("day"))


@registered
def emergency_days(spark, sf_dir):
    """Members and days of emergency visits."""
    return _days(spark, sf_dir, "emergency")


@registered
def transfer_days(spark, sf_dir):
    """Members and days of acute transfers."""
    return _days(spark, sf_dir, "transfer")


@registered
def covered_days(spark, sf_dir):
    """Days covered by each kind of signal, the day after included."""
    return claim_signals(claims(spark, sf_dir)).select(
        MEMBER,
        F.col(DAY).alias("day"),
        *[as_yes_no(has_signal(KINDS, kind)).alias(kind) for kind in KINDS],
    )


def _with_signals(spark, sf_dir, candidates):
    covered = claim_signals(claims(spark, sf_dir))
    return add_signals(candidates, covered, MEMBER, DAY, spread_by=[KEY, "position"])


def _flag(df, kind, name):
    return df.select(
        MEMBER,
        "caseadmitid",
        KEY,
        DAY,
        "ccs",
        "position",
        as_yes_no(has_signal(KINDS, kind)).alias(name),
    )


@registered
def emergency_flag_ip(spark, sf_dir):
    """Inpatient candidates with the emergency flag."""
    found = _with_signals(spark, sf_dir, _allowed_inpatient(spark, sf_dir))
    return _flag(found, "emergency", "after_visit_yn")


@registered
def transfer_flag_ip(spark, sf_dir):
    """Inpatient candidates with the transfer flag."""
    found = _with_signals(spark, sf_dir, _allowed_inpatient(spark, sf_dir))
    return _flag(found, "transfer", "after_transfer_yn")


@registered
def emergency_flag_op(spark, sf_dir):
    """Outpatient candidates with the emergency flag."""
    found = _with_signals(spark, sf_dir, _outpatient(spark, sf_dir))
    return _flag(found, "emergency", "after_visit_yn")


def _after_error(spark, sf_dir, days):
    events = _event_days(spark, sf_dir)
    kinds = {"error": (F.col("event_type") == "error", "day")}
    covered = signal_days(events, "user_id", kinds, days)
    found = add_signals(events, covered, "user_id", "day", spread_by=["event_id"])
    return found.select(
        "event_id", "user_id", "day", as_yes_no(has_signal(["error"], "error")).alias("after_error")
    )


@registered
def event_error_lookback_1d(spark, sf_dir):
    """Events with an error of the same user on the day or the day before."""
    return _after_error(spark, sf_dir, 1)


@registered
def event_error_lookback_3d(spark, sf_dir):
    """Events with an error of the same user on the day or three days before."""
    return _after_error(spark, sf_dir, 3)


def _event_days(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day")
    )


def _with_last_error(spark, sf_dir):
    events = _event_days(spark, sf_dir)
    kinds = {"error": (F.col("event_type") == "error", "day")}
    blocks = signal_blocks(events, "user_id", kinds)
    return add_last_signals(events, blocks, ["error"], "user_id", "day", spread_by=["event_id"])


@registered
def event_error_lookback_90d(spark, sf_dir):
    """Events with an error of the same user on the day or up to 90 days before."""
    flag = as_yes_no(came_within("error", "day", 90)).alias("after_error")
    return _with_last_error(spark, sf_dir).select("event_id", "user_id", "day", flag)


@registered
def event_days_since_error(spark, sf_dir):
    """How many days ago the same user's last error was; null where there was none."""
    since = F.datediff("day", "last_error").alias("days_since")
    return _with_last_error(spark, sf_dir).select("event_id", "user_id", since)


@registered
def preventable_ip(spark, sf_dir):
    """Inpatient candidates with the preventable flag."""
    found = _with_signals(spark, sf_dir, _allowed_inpatient(spark, sf_dir))
    flagged = with_preventable(found, "transfer", "emergency")
    return flagged.select(KEY, "ccs", "position", "preventable_yn")


@registered
def preventable_op(spark, sf_dir):
    """Allowed outpatient candidates with the preventable flag."""
    found = _with_signals(spark, sf_dir, _allowed_outpatient(spark, sf_dir))
    return with_preventable(found, "emergency").select(KEY, "ccs", "position", "preventable_yn")


# The choice and the branches


@registered
def case_primary(spark, sf_dir):
    """The candidate chosen for each admission."""
    return primary_per_case(_allowed_inpatient(spark, sf_dir))


@registered
def member_day_latest(spark, sf_dir):
    """The candidate chosen for each member and day."""
    return latest_per_member_day(_allowed_outpatient(spark, sf_dir))


@registered
def inpatient_chosen(spark, sf_dir):
    """The inpatient branch."""
    return inpatient_branch(claims(spark, sf_dir), code_tables(spark, sf_dir))


@registered
def outpatient_chosen(spark, sf_dir):
    """The outpatient branch."""
    return outpatient_branch(claims(spark, sf_dir), code_tables(spark, sf_dir))


@registered
def branch_union(spark, sf_dir):
    """Both branches together."""
    lines, refs = claims(spark, sf_dir), code_tables(spark, sf_dir)
    return inpatient_branch(lines, refs).unionByName(outpatient_branch(lines, refs))


@registered
def decorate_claims(spark, sf_dir):
    """The full decoration, one row per line."""
    return decorate(claims(spark, sf_dir), code_tables(spark, sf_dir))


@registered
def decorator_object(spark, sf_dir):
    """The full decoration through the decorator class."""
    return SurgeryDecorator().calc_decorator(
        dfs_input={"outclaims": claims(spark, sf_dir)}, dfs_refs=code_tables(spark, sf_dir)
    )


@registered
def two_decorators(spark, sf_dir):
    """Two decorators with other rules each, their columns put back in one join."""
    decorators = [SurgeryDecorator(), SurgeryDecorator(LONG_LOOKBACK, prefix="psp90_")]
    lines = _stored_claims(spark, sf_dir, new_shared_folder(spark))
    return calc_decorators(decorators, {"outclaims": lines}, code_tables(spark, sf_dir))


ORDER_FIELDS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderdate", T.DateType()),
    ]
)


@registered
def bad_order_rows(spark, sf_dir):
    """Rows of written files that a strict read would refuse, and why."""
    folder = f"{new_shared_folder(spark)}/orders"
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date").cast("string")
    customer = F.when(key % 50 == 0, "n/a").otherwise(F.col("o_custkey").cast("string"))
    shown = F.when(key % 70 == 0, "soon").otherwise(day)
    orders = table(spark, sf_dir, "orders")
    written = orders.select(key, customer.alias("o_custkey"), shown.alias("o_orderdate"))
    write_csv(written, folder)
    return bad_rows(spark, folder, ORDER_FIELDS).select("row", "reason")


@registered
def decorate_other_rules(spark, sf_dir):
    """The decoration without lookback and with another inpatient-only category."""
    return decorate(claims(spark, sf_dir), code_tables(spark, sf_dir), NO_LOOKBACK)


@registered
def decorate_long_lookback(spark, sf_dir):
    """The decoration with a lookback of 90 days."""
    return decorate(claims(spark, sf_dir), code_tables(spark, sf_dir), LONG_LOOKBACK)


@registered
def decorate_stored(spark, sf_dir):
    """The full decoration of claims that were written and read back, as in production."""
    folder = new_shared_folder(spark)
    lines = _stored_claims(spark, sf_dir, folder)
    return decorate(lines, split_codes(_codes_from_files(spark, sf_dir, folder)))


# Code tables


def _codes_from_files(spark, sf_dir, folder):
    write_csv(code_table(spark, sf_dir), f"{folder}/codes")
    return read_code_tables(spark, f"{folder}/codes")


@registered
def code_table_from_files(spark, sf_dir):
    """The code table written as CSV and read back."""
    return _codes_from_files(spark, sf_dir, new_shared_folder(spark))


@registered
def code_files_by_type(spark, sf_dir):
    """Codes per type over a folder of files, each read as a table of its own."""
    folder = f"{new_shared_folder(spark)}/codes"
    write_csv(code_table(spark, sf_dir), folder)
    tables = read_folder(spark, folder, dict.fromkeys(tables_in(spark, folder), CODES))
    codes = reduce(DataFrame.unionAll, tables.values())
    return codes.groupBy("code_type").agg(
        F.count("*").alias("n_codes"), F.min("code").alias("first_code")
    )


@registered
def code_table_all(spark, sf_dir):
    """The whole code table."""
    return code_table(spark, sf_dir)


@registered
def code_table_split(spark, sf_dir):
    """The three code tables, each row with the name of its table."""
    tables = code_tables(spark, sf_dir)
    named = [df.select(F.lit(name).alias("table_name"), "code", "ccs") for name, df in tables.items()]
    return named[0].union(named[1]).union(named[2])


@registered
def code_conflict_report(spark, sf_dir):
    """Codes with more than one category."""
    return code_conflicts(code_table(spark, sf_dir))


@registered
def code_coverage_report(spark, sf_dir):
    """Entries per category and code type, with named categories that have none."""
    return code_coverage(code_table(spark, sf_dir), CODE_TYPES, NAMED_CATEGORIES)


# Comparisons and checks


def _stored_claims(spark, sf_dir, folder):
    """Claims written and read back, as a user would have them."""
    write_parquet(claims(spark, sf_dir), f"{folder}/claims")
    return read_parquet(spark, f"{folder}/claims", CLAIMS)


def _under_rule_sets(spark, sf_dir, **rule_sets):
    lines = _stored_claims(spark, sf_dir, new_shared_folder(spark))
    return decorate_under(lines, code_tables(spark, sf_dir), rule_sets)


@registered
def decorate_rule_sets(spark, sf_dir):
    """The decoration under three rule sets at once, one row per line and rule set."""
    sets = {"default": RULES, "other": NO_LOOKBACK, "long": LONG_LOOKBACK}
    both = _under_rule_sets(spark, sf_dir, **sets)
    named = [F.struct(F.lit(name).alias("rule_set"), F.col(name).alias("r")) for name in sets]
    return both.select(KEY, F.inline(F.array(*named))).select(KEY, "rule_set", "r.*")


@registered
def rules_difference(spark, sf_dir):
    """Where the decoration changes when the rules do, cell by cell."""
    both = _under_rule_sets(spark, sf_dir, default=RULES, other=NO_LOOKBACK)
    return field_differences(both, [KEY], "default", "other")


@registered
def rules_difference_counts(spark, sf_dir):
    """Number of lines that change, per column."""
    both = _under_rule_sets(spark, sf_dir, default=RULES, other=NO_LOOKBACK)
    return field_miss_counts(both, "default", "other")


@registered
def rules_beside(spark, sf_dir):
    """The decorations of both rules beside each other."""
    lines = _stored_claims(spark, sf_dir, new_shared_folder(spark))
    refs = code_tables(spark, sf_dir)
    return beside(decorate(lines, refs), decorate(lines, refs, NO_LOOKBACK), [KEY])


def _changed_items(spark, sf_dir):
    """Items, and the same with some quantities changed and some rows left out or twice."""
    items = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 != 0, F.col("l_orderkey")).alias("l_orderkey"),
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").cast("long").alias("l_quantity"),
    )
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    quantity = F.col("l_quantity") + F.when(order % 400 == 1, 1).otherwise(0)
    times = F.when(part % 97 == 5, 0).when(part % 89 == 7, 2).otherwise(1)
    copies = F.explode(F.array_repeat(F.lit(0), times))
    changed = items.select(
        "l_orderkey", "l_linenumber", "l_partkey", quantity.alias("l_quantity"), copies
    ).drop("col")
    return items, changed


@registered
def item_differences(spark, sf_dir):
    """Differences of two tables with repeated keys, a third of which are null."""
    return differences(*_changed_items(spark, sf_dir), ["l_orderkey", "l_linenumber"])


@registered
def item_difference_counts(spark, sf_dir):
    """Number of keys that differ in these tables, per column."""
    key = ["l_orderkey", "l_linenumber"]
    return miss_counts(differences(*_changed_items(spark, sf_dir), key), key)


@registered
def claims_with_decoration(spark, sf_dir):
    """Claims and their decoration, both kept in buckets of the key, beside each other."""
    folder = new_shared_folder(spark)
    lines = write_bucketed(claims(spark, sf_dir), f"{folder}/claims", KEY, BUCKETS)
    decorated = decorate_bucketed(lines, code_tables(spark, sf_dir))
    stored = write_bucketed(decorated, f"{folder}/decorated", KEY, BUCKETS)
    return lines.beside(stored).select(KEY, MEMBER, DAY, "hcpcs", *RESULT[1:])


@registered
def published_versions(spark, sf_dir):
    """Lines per category and flag in two published versions of a decoration."""
    folder = new_shared_folder(spark)
    lines, refs = _stored_claims(spark, sf_dir, folder), code_tables(spark, sf_dir)
    for rules in (RULES, NO_LOOKBACK):
        publish_decoration(lines, decorate(lines, refs, rules), f"{folder}/decorated")
    versions = [
        read_published(spark, f"{folder}/decorated", number)
        .groupBy("psp_category", "psp_preventable_yn")
        .agg(F.count("*").alias("n_lines"))
        .withColumn("version", F.lit(number))
        for number in (1, 2)
    ]
    return versions[0].unionByName(versions[1])


@registered
def output_contract(spark, sf_dir):
    """What is wrong with the decoration: nothing, so all counts of faults are 0.

    The faults are counted while the decoration is written.
    """
    folder = new_shared_folder(spark)
    lines = _stored_claims(spark, sf_dir, folder)
    decorated = decorate(lines, code_tables(spark, sf_dir))
    checks, path = decoration_checks(), f"{folder}/decorated"
    counts = write_observed(decorated, path, checks, KEY)
    return written_report(lines, read_parquet(spark, path), counts, checks, KEY)


@registered
def broken_contract(spark, sf_dir):
    """The same report where much is wrong: orders held against their items."""
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), "o_orderpriority"
    )
    rules = {"priority": F.col("o_orderpriority") != "5-LOW"}
    return contract_report(items, orders, "key", rules)
