"""Schemas, fixed ones and ones described by a table of columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import types as T

SLOT_COUNT = 10

# Datatype words of a descriptor.
_TYPES = {
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def schema_from_rows(rows: Iterable[tuple[str, str, str]]) -> T.StructType:
    """Schema from (name, datatype, nullable) rows, all three given as text."""
    fields = []
    for name, datatype, nullable in rows:
        flag = nullable.strip().lower()
        if flag not in ("true", "false"):
            raise ValueError(f"nullable of {name!r} must be true or false, not {nullable!r}")
        if datatype.strip() not in _TYPES:
            raise ValueError(f"unknown datatype {datatype!r} of {name!r}")
        fields.append(T.StructField(name.strip(), _TYPES[datatype.strip()], flag == "true"))
    return T.StructType(fields)


def rows_from_schema(schema: T.StructType) -> list[tuple[str, str, str]]:
    """The (name, datatype, nullable) rows that describe a schema."""
    words = {datatype: word for word, datatype in _TYPES.items()}
    return [(f.name, words[f.dataType], str(f.nullable).lower()) for f in schema]


def _nullable(**columns: str) -> T.StructType:
    return schema_from_rows((name, datatype, "true") for name, datatype in columns.items())


DESCRIPTOR = _nullable(name="string", datatype="string", nullable="string")

# The columns of a claim line, one row per sequencenumber.
CLAIMS = _nullable(
    sequencenumber="long",
    member_id="string",
    caseadmitid="string",
    claimid="string",
    line_number="string",
    prm_fromdate="date",
    prm_todate="date",
    prm_drg="string",
    hcpcs="string",
    revcode="string",
    **{f"icdproc{n}": "string" for n in range(1, SLOT_COUNT + 1)},
    mr_line_case="string",
    mr_allowed="long",
    prm_acute_transfer_to_acute_yn="string",
    prm_prv_id_operating="string",
    paiddate="date",
)

# The columns of a code table.
CODES = _nullable(code="string", code_description="string", code_type="string", ccs="string")


def read_descriptor(spark: SparkSession, path: str) -> T.StructType:
    """Schema from a CSV file with the columns name, datatype, nullable.

    One row per column of a table, so collecting it is safe.
    """
    rows = (
        spark.read.schema(DESCRIPTOR)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
        .collect()
    )
    return schema_from_rows((r["name"], r["datatype"], r["nullable"]) for r in rows)
