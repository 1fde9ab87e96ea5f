"""Exact distinct counts per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exclude_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose ``column`` is none of ``values``. Rows with a NULL there drop as well."""
    if not values:
        return df.filter(F.col(column).isNotNull())
    return df.filter(~F.col(column).isin(list(values)))


def distinct_per_group(
    df: DataFrame, group: str, value: str, exclude: Sequence[str] = (), out: str = "route_count"
) -> DataFrame:
    """Number of distinct non-NULL values per group, largest first.

    Spark shuffles on (group, value) first and on the group only afterwards, with counts
    instead of values, so one large group is spread over all tasks.
    """
    counts = (
        exclude_values(df, group, exclude)
        .groupBy(group)
        .agg(F.count_distinct(F.col(value)).alias(out))
    )
    return counts.orderBy(F.desc(out), F.asc(group))
