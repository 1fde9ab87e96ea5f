"""Readers for merged tables and for trees of dated snapshots."""

from stoploom.sources.snapshots import (
    SnapshotFile,
    column_names,
    discover,
    manifest,
    merge_all,
    merge_snapshots,
)
from stoploom.sources.tables import read_csv_table, read_table

__all__ = [
    "SnapshotFile",
    "column_names",
    "discover",
    "manifest",
    "merge_all",
    "merge_snapshots",
    "read_csv_table",
    "read_table",
]
