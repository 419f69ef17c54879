"""Reading and writing tables. No schema is ever inferred: codes have leading zeros."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from pathlib import PurePosixPath
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# how fields are told apart, the same in the strict read and in the report
_CSV = {"header": True, "sep": ",", "columnPruning": False}
_BAD = "_bad_row"
_END = "\ue000"  # put behind a row as one field more, to see how many there are before it


def _csv_options(skip_blanks: bool) -> dict:
    return {**_CSV, "ignoreLeadingWhiteSpace": skip_blanks}


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, skip_blanks: bool = True
) -> DataFrame:
    """Comma-separated files with a header, read strictly.

    A row that does not fit the schema fails the job, whichever columns are asked for: every
    row is parsed whole, so a broken one cannot pass as a shorter one. A header that
    differs from the schema fails it too, and an empty field is null. Blanks before a field
    are skipped: a blank before an opening quote would otherwise split the quoted text.
    ``bad_rows`` tells which rows make the read fail.
    """
    return (
        spark.read.schema(schema)
        .options(**_csv_options(skip_blanks))
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )


def bad_rows(
    spark: SparkSession, path: str | list[str], schema: T.StructType, skip_blanks: bool = True
) -> DataFrame:
    """The rows that make ``read_csv`` fail: file, the row as it stands there, and why.

    Columns ``path, row, reason``; the reason is the number of fields or else the columns whose
    field does not fit their type. No rows if all is well. A header that differs is not
    reported here: the strict read says so itself.
    """
    read = (
        spark.read.schema(T.StructType([*schema, T.StructField(_BAD, T.StringType())]))
        .options(**_csv_options(skip_blanks))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD)
        .csv(path)
    )
    # one field more than there may be, for the end, all as text
    wide = T.StructType([T.StructField(f"f{n}", T.StringType()) for n in range(len(schema) + 1)])
    options = {"sep": ",", "ignoreLeadingWhiteSpace": str(skip_blanks).lower()}
    ended = F.concat(F.col(_BAD), F.lit("," + _END))
    fields = F.from_csv(ended, F.lit(wide.toDDL()), options)
    bad = read.where(F.col(_BAD).isNotNull()).select(
        F.col("_metadata.file_path").alias("path"), "*", fields.alias("_fields")
    )
    given = [F.col("_fields")[f.name] for f in wide]
    count = (F.array_position(F.array(*given), _END) - 1).cast("int")
    open_quote = reduce(or_, [F.coalesce(g.endswith(_END), F.lit(False)) for g in given])
    wrong = [
        F.when(
            given[n].isNotNull() & F.col(f"`{f.name}`").isNull(),
            F.concat(F.lit(f"{f.name}: "), given[n], F.lit(f" is no {f.dataType.simpleString()}")),
        )
        for n, f in enumerate(schema)
    ]
    unfit = F.array_join(F.array_compact(F.array(*wrong)), "; ")
    reason = (
        F.when((count < 0) & open_quote, "a quote that is not closed")
        .when(count < 0, f"more than {len(schema)} fields")
        .when(count < len(schema), F.format_string(f"%d fields, not {len(schema)}", count))
        .otherwise(unfit)
    )
    return bad.select("path", F.col(_BAD).alias("row"), reason.alias("reason"))


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet, the format to keep claims in: only the needed columns are read.

    With a schema, a column that the files lack or hold with another type is an error; Spark
    by itself would read an absent column as null.
    """
    found = spark.read.parquet(path)
    if schema is None:
        return found
    check_columns(found, schema, path)
    return found.select(*schema.names)


def check_columns(df: DataFrame, schema: T.StructType, name: str) -> None:
    """Raise unless ``df`` has the schema's columns with their types; it may have more."""
    types = {f.name: f.dataType for f in df.schema}
    wrong = [
        f"{f.name} ({types[f.name].simpleString() if f.name in types else 'absent'},"
        f" not {f.dataType.simpleString()})"
        for f in schema
        if types.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError(f"columns of {name}: {', '.join(wrong)}")


def tables_in(spark: SparkSession, folder: str, suffix: str = ".csv") -> dict[str, str]:
    """Path of each file in a folder by its bare name; only the listing is read."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*" + suffix)
        .load(folder)
        .select("path")
        .collect()
    )
    paths = sorted(row["path"] for row in listing)
    return {unquote(PurePosixPath(p).name)[: -len(suffix)]: p for p in paths}


def read_folder(
    spark: SparkSession, folder: str, schemas: Mapping[str, T.StructType]
) -> dict[str, DataFrame]:
    """Every CSV file of a folder as a named table; each name needs a schema."""
    paths = tables_in(spark, folder)
    missing = sorted(set(paths) - set(schemas))
    if missing:
        raise ValueError(f"no schema for: {', '.join(missing)}")
    return {name: read_csv(spark, path, schemas[name]) for name, path in paths.items()}


def write_parquet(
    df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()
) -> None:
    """Write a result; by default an existing target is left alone and the call fails."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write comma-separated files with a header, as ``read_csv`` reads them."""
    df.write.mode(mode).option("header", True).csv(path)


def new_shared_folder(spark: SparkSession) -> str:
    """A new folder that every executor sees, for tables written between two steps.

    It lies in ``spark.checkpoint.dir`` or, where that is unset, in the warehouse, and goes
    when the session's driver ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{shared.rstrip('/')}/claimloom-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder
