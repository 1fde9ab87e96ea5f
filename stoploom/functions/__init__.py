"""Column expressions. Everything here stays inside Spark's generated code."""

from stoploom.functions.clock import (
    clock_seconds,
    day_type,
    epoch_seconds,
    iso_weekday,
    snapshot_day,
)
from stoploom.functions.numbers import as_double, grid_cell, truncated_ratio
from stoploom.functions.text import dashed, field_count, key_text, prefix, trim_all, trimmed

__all__ = [
    "as_double",
    "clock_seconds",
    "dashed",
    "day_type",
    "epoch_seconds",
    "field_count",
    "grid_cell",
    "iso_weekday",
    "key_text",
    "prefix",
    "snapshot_day",
    "trim_all",
    "trimmed",
    "truncated_ratio",
]
