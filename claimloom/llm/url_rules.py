"""URL filtering by rules for hosts and paths (operator 12), DataFrame functions only.

Each distinct host and path is expanded into expressions, a suffix of the host with a
prefix of the path. Expressions and rules meet on a short prefix of their hashes, then the
full digests are compared, and of the rules that fit the longest decides. Only suffixes and
prefixes of a length that some rule has are made, so that nothing is left out and no url
gives more expressions than the rules have shapes.

Defined results: a null url, or one without ``://``, has an empty host and path; hosts are
compared in lower case (A-Z only), paths as they are; a rule's host fits itself and its
subdomains, an empty one every host; a rule with a null fits nothing; of equally long rules
that with the longer host decides, then a blocking one. Repeated rows are judged each;
other columns are kept or not read, whatever their names; no rules or rows is no error.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.operators.sizing import fits_broadcast, spread_join

ALLOW, BLOCK = "allow", "block"

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_PREFIX_DIGITS = 8
_TARGET = ["host", "path"]


def _lower(host: Column) -> Column:
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the path, in lower case; never null."""
    return _lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host, up to the query or the fragment; never null."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _labels(host: Column) -> Column:
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.split(host, r"\."))


def _digest(host: Column, path: Column) -> Column:
    """Of the expression; the host's length keeps host and path apart."""
    return F.sha2(F.concat_ws(":", F.length(host).cast("string"), F.concat(host, path)), 256)


def _hashed(df: DataFrame, host: Column, path: Column, *others: str | Column) -> DataFrame:
    digest = _digest(host, path)
    prefix = F.substring(digest, 1, _PREFIX_DIGITS)
    return df.select(prefix.alias("prefix"), digest.alias("digest"), *others)


def _prepared(rules: DataFrame) -> DataFrame:
    """Rules with their hash, and ``worth``, by which the deciding one is chosen."""
    host, path = F.col("host"), F.col("path")
    plain = rules.select(
        _lower(host.cast("string")).alias("host"), path.cast("string").alias("path"), "verdict"
    ).dropna()
    rule = F.concat(host, path)
    worth = F.struct(
        F.length(rule).alias("length"),
        F.length(host).alias("host_length"),
        (F.col("verdict") == BLOCK).alias("blocks"),
        rule.alias("rule"),
        F.col("verdict").alias("verdict"),
    )
    return _hashed(plain, host, path, worth.alias("worth")).distinct()


def rule_shapes(rules: DataFrame) -> dict[int, list[int]]:
    """Path lengths that occur among the rules, by their hosts' number of labels.

    Bounded by the lengths of single rules: however many rules there are, each number of labels
    and each length come once.
    """
    host, path = F.col("host").cast("string"), F.col("path").cast("string")
    shapes = rules.select(host.alias("host"), path.alias("path"), "verdict").dropna().select(
        F.size(_labels(F.col("host"))).alias("labels"), F.length("path").alias("length")
    )
    found: dict[int, list[int]] = {}
    for row in shapes.distinct().orderBy("labels", "length").collect():
        found.setdefault(row["labels"], []).append(row["length"])
    return found


def expressions(targets: DataFrame, shapes: dict[int, list[int]]) -> DataFrame:
    """One row per host, path and expression that some rule might be, with its hash."""
    host, path = F.col("host"), F.col("path")
    expression = "array<struct<suffix:string,start:string>>"
    labels = _labels(host)

    def of_labels(count: int, lengths: Sequence[int]) -> Column:
        suffix = F.array_join(F.slice(labels, -count, count), ".") if count else F.lit("")
        fitting = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path))
        made = F.transform(
            fitting,
            lambda n: F.struct(
                suffix.alias("suffix"), F.substring(path, F.lit(1), n).alias("start")
            ),
        )
        return F.when(F.size(labels) >= count, made).otherwise(F.array().cast(expression))

    made = [of_labels(count, lengths) for count, lengths in shapes.items()]
    every = F.concat(*made) if made else F.array().cast(expression)
    exploded = targets.select(*_TARGET, F.explode(every).alias("e")).select(*_TARGET, "e.*")
    return _hashed(exploded, F.col("suffix"), F.col("start"), *_TARGET)


def deciding_rules(targets: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest rule for each distinct host and path that has one.

    The rules are broadcast if their measured size allows; otherwise both sides are
    shuffled by hash prefix, with the expressions of many urls, such as a top-level domain,
    split into parts.
    """
    made = expressions(targets.select(*_TARGET).distinct(), rule_shapes(rules))
    table = _prepared(rules).withColumnRenamed("digest", "rule_digest")
    if fits_broadcast(table):
        met = made.join(F.broadcast(table), "prefix")
    else:
        met = spread_join(made, table, ["prefix"], "inner", spread_by=_TARGET)
    confirmed = met.where(F.col("digest") == F.col("rule_digest"))
    return confirmed.groupBy(*_TARGET).agg(F.max("worth").alias("worth"))


def judge(
    pages: DataFrame,
    rules: DataFrame,
    keep: Sequence[str] = ("page_id",),
    url: str = "url",
    otherwise: str = ALLOW,
) -> DataFrame:
    """Each row's ``keep`` columns as the struct ``page``, with host, path, rule and verdict.

    ``rules`` has the columns host, path and verdict; a row that none fits gets ``otherwise``.
    """
    address = F.col(url).cast("string")
    rows = pages.select(
        F.struct(*keep).alias("page"),
        url_host(address).alias("host"),
        url_path(address).alias("path"),
    )
    decided = deciding_rules(rows, rules)
    met = spread_join(rows, decided, _TARGET, "left", spread_by=["page"])
    return met.select(
        "page",
        *_TARGET,
        F.col("worth.rule").alias("rule"),
        F.coalesce("worth.verdict", F.lit(otherwise)).alias("verdict"),
    )


def keep_allowed(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """The rows of ``pages`` whose url is not blocked, with their columns."""
    judged = judge(pages, rules, keep=pages.columns, url=url)
    return judged.where(F.col("verdict") != BLOCK).select("page.*")
