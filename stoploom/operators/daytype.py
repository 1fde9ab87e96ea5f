"""Operator labels, trips from headways, and average service by day type."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stoploom.functions.clock import day_type
from stoploom.functions.numbers import truncated_ratio
from stoploom.functions.text import ColumnOrName, prefix

DAY_TYPES = ("weekday", "weekend")


def switch_to_prefix(
    df: DataFrame, column: str, when_value: str, source: str, length: int = 3
) -> DataFrame:
    """Where ``column`` is ``when_value``, replace it by the first characters of ``source``."""
    return df.withColumn(
        column,
        F.when(F.col(column) == when_value, prefix(source, length)).otherwise(F.col(column)),
    )


def relabel(df: DataFrame, column: str, mapping: Mapping[str, str] | DataFrame) -> DataFrame:
    """Replace the values of ``column`` found in ``mapping``; others pass through.

    A dict becomes a CASE expression and suits a few dozen labels. A longer dictionary is
    given as a DataFrame with columns ``key`` and ``label`` and is joined; Spark broadcasts it
    when it is below its size threshold and shuffles it otherwise. Of several labels for one key
    the smallest counts, so that a row never multiplies.
    """
    if not isinstance(mapping, DataFrame):
        return df.replace(dict(mapping), subset=[column]) if mapping else df
    labels = mapping.groupBy(F.col("key").alias("_key")).agg(F.min("label").alias("_label"))
    joined = df.join(labels, F.col(column) == F.col("_key"), "left")
    relabelled = F.when(F.col("_key").isNotNull(), F.col("_label")).otherwise(F.col(column))
    return joined.withColumn(column, relabelled).select(*df.columns)


def trips_from_headway(
    df: DataFrame, duration: ColumnOrName, headway: ColumnOrName, out: str = "num_trips"
) -> DataFrame:
    """Trips that fit a service window: duration over headway, cut towards zero.

    Windows that end before they start give negative trips. A zero headway gives NULL.
    """
    return df.withColumn(out, truncated_ratio(duration, headway))


def daily_sum(df: DataFrame, keys: Sequence[str], day: str, value: str, out: str) -> DataFrame:
    """Sum of ``value`` per key and day."""
    return df.groupBy(*keys, day).agg(F.sum(F.col(value).cast("bigint")).alias(out))


def avg_by_day_type(
    df: DataFrame,
    operator: str,
    day: str,
    value: str,
    rounding: str = "truncate",
    out: str = "avg_daily_trips",
    ordered: bool = True,
) -> DataFrame:
    """Mean of the daily sums of ``value`` per operator and day type, as a whole number.

    NULL values add nothing; days without any value, and the NULL day, do not count.
    ``rounding`` is ``truncate`` (towards zero) or ``half_up``. ``ordered`` sorts the result.
    """
    if rounding not in ("truncate", "half_up"):
        raise ValueError(f"rounding must be 'truncate' or 'half_up', not {rounding!r}")
    mean = F.avg("_daily")
    if rounding == "half_up":
        mean = F.floor(mean + 0.5)
    daily = daily_sum(df, [operator], day, value, "_daily")
    averages = (
        daily.filter(F.col(day).isNotNull() & F.col("_daily").isNotNull())
        .withColumn("day_type", day_type(day))
        .groupBy(operator, "day_type")
        .agg(mean.cast("bigint").alias(out))
    )
    return averages.orderBy(operator, "day_type") if ordered else averages


def pivot_day_type(
    averages: DataFrame,
    operator: str,
    value: str = "avg_daily_trips",
    fill: int | None = None,
) -> DataFrame:
    """One row per operator with a column per day type; absent ones are NULL or ``fill``."""
    wide = averages.groupBy(operator).pivot("day_type", list(DAY_TYPES)).agg(F.first(value))
    columns = {name: f"{name}_{value}" for name in DAY_TYPES}
    wide = wide.withColumnsRenamed(columns)
    if fill is not None:
        wide = wide.na.fill(fill, subset=list(columns.values()))
    return wide.orderBy(operator)
