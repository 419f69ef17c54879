"""Schemas from descriptors, strict CSV, folders of tables, code tables, writing."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from claimloom.sources import (
    CLAIMS,
    CODES,
    read_code_tables,
    new_shared_folder,
    read_csv,
    read_descriptor,
    read_folder,
    read_parquet,
    rows_from_schema,
    schema_from_rows,
    split_codes,
    tables_in,
    write_csv,
    write_parquet,
)
from tests.made_claims import codes

HEADER = "code,code_description,code_type,ccs\n"


def test_schema_from_rows():
    schema = schema_from_rows(
        [("id", "long", "true"), ("code", "string", "false"), ("day", "date", "True")]
    )
    assert schema == T.StructType(
        [
            T.StructField("id", T.LongType(), True),
            T.StructField("code", T.StringType(), False),
            T.StructField("day", T.DateType(), True),
        ]
    )


@pytest.mark.parametrize("row", [("id", "text", "true"), ("id", "long", "perhaps")])
def test_schema_rejects_unknown_words(row):
    with pytest.raises(ValueError, match="id"):
        schema_from_rows([row])


def test_descriptor_file_gives_the_claims_schema(spark, tmp_path):
    path = tmp_path / "claims.csv"
    rows = rows_from_schema(CLAIMS)
    assert rows[0] == ("sequencenumber", "long", "true")
    path.write_text("\n".join(["name,datatype,nullable", *map(",".join, rows)]))
    assert read_descriptor(spark, str(path)) == CLAIMS


def test_leading_zeros_and_blanks_survive(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + '028,,MSDRG,ccs61\n0450,"a, b",CPT_HCPCS,\n')
    rows = read_csv(spark, str(tmp_path / "a.csv"), CODES).collect()
    assert [tuple(r) for r in rows] == [
        ("028", None, "MSDRG", "ccs61"),
        ("0450", "a, b", "CPT_HCPCS", None),
    ]


def test_blank_before_a_quote_does_not_split_the_field(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + 'B2, "cut, lower; part",CPT_HCPCS,ccs78\n')
    row = read_csv(spark, str(tmp_path / "a.csv"), CODES).first()
    assert tuple(row) == ("B2", "cut, lower; part", "CPT_HCPCS", "ccs78")


def test_bad_row_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,day\n1,2020-01-01\nx,2020-01-02\n")
    schema = schema_from_rows([("id", "long", "true"), ("day", "date", "true")])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_csv(spark, str(tmp_path / "a.csv"), schema).collect()


def test_other_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("code,ccs,code_type,code_description\n028,ccs61,MSDRG,x\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_csv(spark, str(tmp_path / "a.csv"), CODES).collect()


def test_folder_gives_named_tables(spark, tmp_path):
    (tmp_path / "drg.csv").write_text(HEADER + "101,x,MSDRG,ccs61\n")
    (tmp_path / "hcpcs.csv").write_text(HEADER + "A1001,y,CPT_HCPCS,ccs33\n")
    (tmp_path / "notes.txt").write_text("not a table")
    assert set(tables_in(spark, str(tmp_path))) == {"drg", "hcpcs"}
    tables = read_folder(spark, str(tmp_path), {"drg": CODES, "hcpcs": CODES})
    assert {n: df.first()["code"] for n, df in tables.items()} == {"drg": "101", "hcpcs": "A1001"}
    with pytest.raises(ValueError, match="hcpcs"):
        read_folder(spark, str(tmp_path), {"drg": CODES})


def test_code_tables_load_together_and_split(spark, tmp_path):
    (tmp_path / "code_a.csv").write_text(HEADER + "101,x,MSDRG,ccs61\n0XA1111,y,ICD10_PROC,ccs61\n")
    (tmp_path / "code_b.csv").write_text(HEADER + "A1001,z,CPT_HCPCS,ccs33\nZ9,z,OTHER,ccs33\n")
    tables = split_codes(read_code_tables(spark, str(tmp_path / "code_*.csv")))
    assert {n: [r["code"] for r in df.collect()] for n, df in tables.items()} == {
        "icd_procs": ["0XA1111"],
        "hcpcs": ["A1001"],
        "drg": ["101"],
    }


def test_csv_write_and_read_back(spark, tmp_path):
    path = str(tmp_path / "out")
    write_csv(codes(spark), path)
    assert sorted(read_csv(spark, path, CODES).collect()) == sorted(codes(spark).collect())


def test_shared_folder_lies_where_the_session_says(spark):
    one, other = new_shared_folder(spark), new_shared_folder(spark)
    assert one != other
    assert one.startswith(spark.conf.get("spark.checkpoint.dir") + "/claimloom-")


def test_write_and_read_back(spark, tmp_path):
    path = str(tmp_path / "out")
    write_parquet(codes(spark), path, partition_by=["code_type"])
    back = read_parquet(spark, path, CODES).select(CODES.names)
    assert sorted(back.collect()) == sorted(codes(spark).collect())
    with pytest.raises(PySparkException):
        write_parquet(codes(spark), path)
