"""Readers, writers and folder inventories."""

from .files import (  # noqa: F401
    expected_manifest,
    file_inventory,
    read_csv,
    read_first,
    read_json,
    read_table,
    schema_summary,
    write_audit,
    write_table,
)
