"""Tables kept in buckets of their key, so that joins on the key leave them where they are.

The rows lie below a folder, dealt out by hash of the key into a fixed number of buckets,
each one file sorted by key; rows without a key lie beside them, as they match nothing and would
fill one bucket. The folder outlives the session: its layout is kept with it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.sources import hadoop

_LAYOUT = "layout.json"


@dataclass(frozen=True)
class BucketedTable:
    """``keyed`` are the rows with a key, in buckets; ``loose`` those without."""

    key: str
    buckets: int
    keyed: DataFrame
    loose: DataFrame

    def rows(self) -> DataFrame:
        """All rows, for what needs no buckets."""
        return self.keyed.unionByName(self.loose)

    def beside(self, other: BucketedTable) -> DataFrame:
        """Every row with the other table's row of its key, if any, whose columns are added.

        ``other`` has each key once. With the same number of buckets nothing is shuffled.
        """
        if self.key != other.key:
            raise ValueError(f"kept by {self.key} and {other.key}")
        added = [f for f in other.keyed.schema if f.name != other.key]
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in added]
        met = self.keyed.join(other.keyed, self.key, "left")
        names = [*self.keyed.columns, *[f.name for f in added]]
        return met.select(*names).union(self.loose.select("*", *nothing))


def _registered(
    spark: SparkSession, folder: str, schema: T.StructType, key: str, buckets: int
) -> str:
    """A table of the session's catalogue over the folder; the files are not its own."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
        f"SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{folder}/keyed'"
    )
    return name


def write_bucketed(df: DataFrame, folder: str, key: str, buckets: int) -> BucketedTable:
    """Write ``df`` to a new folder, in ``buckets`` buckets of ``key``, and read it back.

    One shuffle, paid once. Choose the number so that a bucket fits a task, some hundred MB;
    tables that are to be joined need the same number.
    """
    spark = df.sparkSession
    if hadoop.exists(spark, f"{folder}/{_LAYOUT}"):
        raise ValueError(f"there is a table in {folder}")
    name = _registered(spark, folder, df.schema, key, buckets)
    try:
        (
            df.where(F.col(key).isNotNull())
            .repartition(buckets, key)
            .write.format("parquet")
            .mode("append")
            .bucketBy(buckets, key)
            .sortBy(key)
            .saveAsTable(name)
        )
    finally:
        spark.sql(f"DROP TABLE {name}")
    df.where(F.col(key).isNull()).write.mode("overwrite").parquet(f"{folder}/loose")
    layout = {"key": key, "buckets": buckets, "schema": df.schema.jsonValue()}
    hadoop.write_new_text(spark, f"{folder}/{_LAYOUT}", json.dumps(layout))
    return read_bucketed(spark, folder)


def read_bucketed(spark: SparkSession, folder: str) -> BucketedTable:
    """The table in a folder; a write that did not come to its end is an error."""
    path = f"{folder}/{_LAYOUT}"
    if not hadoop.exists(spark, path):
        raise ValueError(f"no complete table in {folder}")
    layout = json.loads(hadoop.read_text(spark, path))
    schema = T.StructType.fromJson(layout["schema"])
    key, buckets = layout["key"], layout["buckets"]
    name = _registered(spark, folder, schema, key, buckets)
    keyed = spark.table(name)
    # the frame has its files and buckets by now and does not need the catalogue
    spark.sql(f"DROP TABLE {name}")
    loose = spark.read.schema(schema).parquet(f"{folder}/loose")
    return BucketedTable(key, buckets, keyed.select(*schema.names), loose)
