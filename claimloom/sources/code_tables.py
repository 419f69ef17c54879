"""Code tables: load the category files as one table, split it by code type."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.sources.files import read_csv
from claimloom.sources.schemas import CODES

# Name of each code table and the code type it is made of.
CODE_TYPES = {"icd_procs": "ICD10_PROC", "hcpcs": "CPT_HCPCS", "drg": "MSDRG"}


def read_code_tables(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All category files under a path, glob or list of paths, as one code table."""
    return read_csv(spark, path, CODES)


def split_codes(
    codes: DataFrame, types: Mapping[str, str] = CODE_TYPES, by: str = "code_type"
) -> dict[str, DataFrame]:
    """One table per code type; a type that no name asks for is left out."""
    return {name: codes.where(F.col(by) == value) for name, value in types.items()}
