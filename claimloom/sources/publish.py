"""Results that are checked while they are written and seen only when they are right.

A result is written to a folder of its own below the table's folder; what must hold is counted
on the way, in the same job. Only then a numbered manifest is added that names the files, and
readers go by the newest manifest. A driver or executor lost half-way leaves files that no
manifest names: they are never read, and the write can simply be repeated.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions import holds
from claimloom.operators.contract import contract_report
from claimloom.operators.diff import digest_sums
from claimloom.sources import hadoop

_MANIFESTS = "manifests"


class BrokenResult(ValueError):
    """What was counted against a result that is therefore not published."""

    def __init__(self, counts: Mapping[str, int]):
        super().__init__(f"result not published: {dict(counts)}")
        self.counts = dict(counts)


def key_digest(df: DataFrame, key: str) -> dict[str, int]:
    """Number of rows and order-free sums over their keys; reads the key column only."""
    sums = digest_sums([key])
    row = df.select(key).agg(*[total.alias(name) for name, total in sums.items()]).first()
    return row.asDict()


def write_observed(
    df: DataFrame,
    folder: str,
    must_hold: Mapping[str, Column],
    key: str,
    partition_by: Sequence[str] = (),
) -> dict[str, int]:
    """Write Parquet and count in the same job: broken conditions, rows, sums over the keys.

    Unknown counts as broken. The counts are taken in the writing tasks; of a task that is
    run again only the run that counts for the result counts here.
    """
    counts = {f"n_broken_{n}": F.count_if(~holds(rule)) for n, rule in must_hold.items()}
    counts["n_null_key_rows"] = F.count_if(F.col(key).isNull())
    counts |= digest_sums([key])
    seen = Observation()
    observed = df.observe(seen, *[total.alias(name) for name, total in counts.items()])
    observed.write.partitionBy(*partition_by).parquet(folder)
    return dict(seen.get)


def publish(
    df: DataFrame,
    folder: str,
    must_hold: Mapping[str, Column],
    key: str,
    same_keys_as: DataFrame | None = None,
    partition_by: Sequence[str] = (),
) -> dict[str, int]:
    """Write, check and publish a result; the counts taken, or ``BrokenResult`` is raised.

    With ``same_keys_as`` the result must hold each key as often as that table, which is
    compared by sums and costs a scan of one column, no shuffle. What is published
    before stays readable until the new manifest is there, and if the result is broken.
    """
    spark = df.sparkSession
    name = f"data-{uuid.uuid4().hex}"
    counts = write_observed(df, f"{folder}/{name}", must_hold, key, partition_by)
    problems = {n: c for n, c in counts.items() if n.startswith("n_broken_") and c}
    if same_keys_as is not None:
        meant = key_digest(same_keys_as, key)
        if any(counts[n] != c for n, c in meant.items()):
            problems |= {"n_lines": meant["n"], "n_result": counts["n"], "other_keys": 1}
    if problems:
        hadoop.remove(spark, f"{folder}/{name}")
        raise BrokenResult(problems)
    files = hadoop.files_in(spark, f"{folder}/{name}")
    manifest = {
        "folder": name,
        "schema": df.schema.jsonValue(),
        "partition_by": list(partition_by),
        "counts": {n: c for n, c in counts.items() if n.startswith("n")},
        "files": [{"path": path, "bytes": size} for path, size in files],
    }
    number = max(_numbers(spark, folder), default=0) + 1
    while not hadoop.write_new_text(
        spark, _manifest_path(folder, number), json.dumps(manifest)
    ):
        number += 1  # somebody else has published meanwhile
    return manifest["counts"]


def written_report(
    lines: DataFrame, result: DataFrame, counts: Mapping[str, int], must_hold, key: str
) -> DataFrame:
    """The row of ``contract_report`` for a written result and the counts of its writing.

    Where the sums over the keys agree, no key is missing or added, and only the lines' own
    keys are grouped, to tell how many repeat. Otherwise the written rows are held
    against the lines key by key.
    """
    meant = key_digest(lines, key)
    if any(counts[n] != c for n, c in meant.items()):
        return contract_report(lines, result, key, must_hold)
    per_key = lines.select(key).groupBy(key).agg(F.count("*").alias("rows"))
    zero = F.lit(0).cast("long")
    return per_key.agg(
        F.coalesce(F.sum("rows"), zero).alias("n_lines"),
        F.lit(counts["n"]).cast("long").alias("n_result"),
        F.lit(2 * counts["n_null_key_rows"]).cast("long").alias("n_null_key_rows"),
        F.count_if(F.col(key).isNotNull() & (F.col("rows") > 1)).alias("n_repeated_keys"),
        zero.alias("n_missing_keys"),
        zero.alias("n_extra_keys"),
        *[
            F.lit(c).cast("long").alias(n)
            for n, c in counts.items()
            if n.startswith("n_broken_")
        ],
    )


def _manifest_path(folder: str, number: int) -> str:
    return f"{folder}/{_MANIFESTS}/{number:08d}.json"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    names = [path for path, _ in hadoop.files_in(spark, f"{folder}/{_MANIFESTS}")]
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]


def read_manifest(spark: SparkSession, folder: str, number: int | None = None) -> dict:
    """The newest manifest, or the one with a given number."""
    numbers = _numbers(spark, folder)
    if not numbers or (number is not None and number not in numbers):
        raise ValueError(f"nothing published in {folder}" + f" under {number}" * bool(number))
    path = _manifest_path(folder, max(numbers) if number is None else number)
    return json.loads(hadoop.read_text(spark, path))


def read_published(spark: SparkSession, folder: str, number: int | None = None) -> DataFrame:
    """The published rows: just the files that the manifest names."""
    manifest = read_manifest(spark, folder, number)
    schema = T.StructType.fromJson(manifest["schema"])
    base = f"{folder}/{manifest['folder']}"
    files = [f"{base}/{f['path']}" for f in manifest["files"]]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*files).select(*schema.names)


def remove_unlisted(spark: SparkSession, folder: str, older_than_seconds: float) -> list[str]:
    """Remove what lost writes have left, if it has not changed for so long; their names."""
    listed = {read_manifest(spark, folder, n)["folder"] for n in _numbers(spark, folder)}
    latest = (time.time() - older_than_seconds) * 1000
    gone = [
        name
        for name, changed in hadoop.folders_in(spark, folder)
        if name.startswith("data-") and name not in listed and changed <= latest
    ]
    for name in gone:
        hadoop.remove(spark, f"{folder}/{name}")
    return gone
