"""Typed readers, code tables and the writer."""

from claimloom.sources.buckets import BucketedTable, read_bucketed, write_bucketed
from claimloom.sources.code_tables import CODE_TYPES, read_code_tables, split_codes
from claimloom.sources.files import (
    bad_rows,
    check_columns,
    new_shared_folder,
    read_csv,
    read_folder,
    read_parquet,
    tables_in,
    write_csv,
    write_parquet,
)
from claimloom.sources.publish import (
    BrokenResult,
    key_digest,
    publish,
    read_manifest,
    read_published,
    remove_unlisted,
    write_observed,
    written_report,
)
from claimloom.sources.schemas import (
    CLAIMS,
    CODES,
    DESCRIPTOR,
    read_descriptor,
    rows_from_schema,
    schema_from_rows,
)

__all__ = [
    "BrokenResult",
    "BucketedTable",
    "CLAIMS",
    "CODES",
    "CODE_TYPES",
    "DESCRIPTOR",
    "bad_rows",
    "check_columns",
    "key_digest",
    "new_shared_folder",
    "publish",
    "read_bucketed",
    "read_code_tables",
    "read_csv",
    "read_descriptor",
    "read_folder",
    "read_manifest",
    "read_parquet",
    "read_published",
    "remove_unlisted",
    "rows_from_schema",
    "schema_from_rows",
    "split_codes",
    "tables_in",
    "write_bucketed",
    "write_csv",
    "write_observed",
    "write_parquet",
    "written_report",
]
