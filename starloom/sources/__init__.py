"""Readers, staging and publishing."""

from starloom.sources.files import (
    constant_table,
    convert,
    read_delimited,
    read_district_file,
    read_json,
    sample_rows,
)
from starloom.sources.snapshot import ConflictError, PublishError, SnapshotTable
from starloom.sources.staging import extract, with_audit

__all__ = [
    "ConflictError", "PublishError", "SnapshotTable", "constant_table", "convert", "extract",
    "read_delimited", "read_district_file", "read_json", "sample_rows", "with_audit",
]
