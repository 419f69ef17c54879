"""Times the decoration on many copies of the claims and checks it against plain SQL.

    python bench_scale.py [COPIES [even|skewed] [FOLDER]]


Each copy has its own keys, members and admissions. In the skewed form a third of all
lines falls on one day; half of those belong to one member and the others to none, and part
of them share one admission. The copies are written to FOLDER, by default a new temporary
one, and used again if they are there.
Prints one JSON line with times, number of rows, and whether the hashes of all rows agree.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import bench
from claimloom import decorate
from claimloom.demo.oracle import stored_decoration_sql
from claimloom.sources import write_parquet

HOT_DAY = "1995-01-05"
LISTED = ((100, "even"), (100, "skewed"), (400, "skewed"))


def copies(lines: DataFrame, n: int, skewed: bool) -> DataFrame:
    """The lines n times over with new keys, optionally with hot members and admissions."""
    copy = F.col("copy")
    hot = F.pmod(F.xxhash64("sequencenumber", copy), F.lit(3)) == 0 if skewed else F.lit(False)
    own = {c: F.concat(F.col(c), F.lit("_"), copy) for c in ("member_id", "caseadmitid")}
    changed = {
        "sequencenumber": F.col("sequencenumber") * n + copy,
        "member_id": F.when(hot, F.when(copy % 2 == 0, F.lit("hot"))).otherwise(own["member_id"]),
        "caseadmitid": F.when(hot & (copy % 4 == 0), F.lit("hot")).otherwise(own["caseadmitid"]),
        "prm_fromdate": F.when(hot, F.lit(HOT_DAY).cast("date")).otherwise(F.col("prm_fromdate")),
    }
    repeated = lines.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return repeated.select(*[changed.get(c, F.col(c)).alias(c) for c in lines.columns])


def timed(query) -> float:
    start = time.perf_counter()
    query().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 1)


def content(df: DataFrame):
    """Row count and a hash that does not depend on the order of rows."""
    row = F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")
    return tuple(df.agg(F.count("*"), F.sum(row)).first())


def main() -> None:
    chosen = LISTED
    if len(sys.argv) > 1:
        chosen = ((int(sys.argv[1]), sys.argv[2] if len(sys.argv) > 2 else "even"),)
    folder = sys.argv[3] if len(sys.argv) > 3 else tempfile.mkdtemp(prefix="scale-")
    spark = bench.session()
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    base, refs = bench.stored(spark, tempfile.mkdtemp(prefix="bench-"))
    for n, form in chosen:
        run(spark, base, refs, n, form, folder)
    spark.stop()


def run(spark, base: DataFrame, refs: dict[str, DataFrame], n: int, form: str, folder: str) -> None:
    path = f"{folder}/claims-{n}-{form}"
    if not os.path.exists(path):
        write_parquet(copies(base.repartition(32), n, form == "skewed"), path)
    lines = spark.read.parquet(path)
    lines.createOrReplaceTempView("claims")
    for view, name in (("icd_procs", "icd_procs"), ("hcpcs_codes", "hcpcs"), ("drg", "drg")):
        refs[name].createOrReplaceTempView(view)

    forms = {
        "library": lambda: decorate(lines, refs),
        "plain_sql": lambda: spark.sql(stored_decoration_sql()),
    }
    times = {name: min(timed(query) for _ in range(2)) for name, query in forms.items()}
    found = {name: content(query()) for name, query in forms.items()}
    print(
        json.dumps(
            {
                "claims": lines.count(),
                "form": form,
                "seconds": times,
                "equal": found["library"] == found["plain_sql"],
            }
        )
    )


if __name__ == "__main__":
    main()
