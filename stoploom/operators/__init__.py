"""Operators: functions from DataFrame to DataFrame with column names as parameters."""

from stoploom.operators.align import lead_with, merge_feeds, stack_by_name
from stoploom.operators.daytype import (
    avg_by_day_type,
    daily_sum,
    pivot_day_type,
    relabel,
    switch_to_prefix,
    trips_from_headway,
)
from stoploom.operators.dedup import (
    distinct_values,
    least_per_key,
    newest_per_key,
    one_per_key,
    singletons,
)
from stoploom.operators.distinct import distinct_per_group, exclude_values
from stoploom.operators.gaps import gap_stats, gaps, headway_stats, lag_per_group, partial_gap_stats
from stoploom.operators.isolated import isolated_cells, isolated_points
from stoploom.operators.quality import (
    count_rejects,
    observe_rejects,
    split_rejects,
    tag_rejects,
)
from stoploom.operators.typing import common_types, with_types

__all__ = [
    "avg_by_day_type",
    "common_types",
    "count_rejects",
    "daily_sum",
    "distinct_per_group",
    "distinct_values",
    "exclude_values",
    "gap_stats",
    "gaps",
    "headway_stats",
    "isolated_cells",
    "isolated_points",
    "lag_per_group",
    "lead_with",
    "least_per_key",
    "merge_feeds",
    "newest_per_key",
    "observe_rejects",
    "one_per_key",
    "partial_gap_stats",
    "pivot_day_type",
    "relabel",
    "singletons",
    "split_rejects",
    "stack_by_name",
    "switch_to_prefix",
    "tag_rejects",
    "trips_from_headway",
    "with_types",
]
