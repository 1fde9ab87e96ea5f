"""Previous row, gaps between consecutive times, and statistics over the gaps."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from stoploom.functions.clock import epoch_seconds
from stoploom.functions.text import ColumnOrName, as_column

ROWS_PER_TASK = 5_000_000
#: Pieces that a large key is cut into when its split points are found by a sketch.
PIECES = 256


def lag_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnOrName],
    value: str,
    out: str,
    slice_by: Column | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``out``: ``value`` of the previous row of the key, NULL on the first row.

    ``order`` must be a total order within a key for repeatable rows.

    Keys of more than ``rows_per_task`` rows are cut: every slice is sorted on its own and gets one
    carried row, the last one of the slice before. The result is that of a plain window.

    ``slice_by`` says where to cut: an expression that never decreases along ``order`` (the hour of a time,
    say); where a cut key breaks the rule, the job fails. Choose it so fine that one slice of the largest key
    is a fair share for a task. Without it, large keys are found by their counts and cut at ``PIECES`` quantiles
    of the first column of ``order``, which a mergeable sketch over their rows gives; rows that share that column's
    value stay together. That takes a number, a date or a time as first column; by any other, and where
    ``order`` names a direction, each key is sorted by one task.
    """
    falling = any(re.search(r"\b(ASC|DESC)\b", str(c)) for c in order if isinstance(c, Column))
    if slice_by is not None and falling:
        raise ValueError("with slice_by, order takes ascending columns; negate what should fall")
    if slice_by is not None:
        base = df.withColumn("_slice", slice_by)
    else:
        base = None if falling else _with_sampled_slices(df, keys, order[0], rows_per_task)
    if base is None:
        window = Window.partitionBy(*keys).orderBy(*[as_column(c) for c in order])
        return df.withColumn(out, F.lag(value).over(window))

    computed = {f"_o{i}": c for i, c in enumerate(order) if isinstance(c, Column)}
    ranks = [f"_o{i}" if isinstance(c, Column) else c for i, c in enumerate(order)]
    base = base.withColumns(computed) if computed else base
    # One row for each key and slice; partial counts leave the map tasks.
    slices = base.groupBy(*keys, "_slice").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(F.struct(*ranks)).alias("_first"),
        F.max(F.struct(*ranks, F.col(value).alias("_value"))).alias("_last"),
    )
    of_key = Window.partitionBy(*keys)
    along = of_key.orderBy("_slice")
    held = slices.withColumns(
        {
            "_total": F.sum("_n").over(of_key),
            "_next": F.lead("_slice").over(along),
            "_from": F.lead("_first").over(along),
        }
    ).filter(F.col("_total") > rows_per_task)
    broken = F.col("_from").isNotNull() & (F.struct(*[F.col("_last").getField(r) for r in ranks]) > F.col("_from"))
    checked = F.when(broken, F.raise_error(F.lit("slice_by decreases along order"))).otherwise(F.lit(1))
    large = held.groupBy(*[F.col(k).alias(f"_large_{k}") for k in keys]).agg(F.max(checked).alias("_cut"))
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_large_{k}")) for k in keys])
    rows = base.join(large, same_key, "left").select(
        *[c for c in base.columns if c != "_slice"],
        F.when(F.col("_cut") == 1, F.col("_slice")).alias("_slice"),
        F.lit(1).alias("_own"),
    )
    carried = held.filter(F.col("_from").isNotNull()).select(
        *keys,
        *([F.col("_last._value").alias(value)] if value not in keys else []),
        F.col("_next").alias("_slice"),
        F.lit(0).alias("_own"),
    )
    # A carried row comes first in its slice and holds nothing but its key and its value.
    in_order = Window.partitionBy(*keys, "_slice").orderBy("_own", *ranks)
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn(out, F.lag(value).over(in_order))
        .filter("_own = 1")
        .select(*df.columns, out)
    )


def _with_sampled_slices(df: DataFrame, keys: Sequence[str], first: ColumnOrName, rows_per_task: int) -> DataFrame | None:
    """``df`` with ``_slice``: how many split points of its key a row has reached, 0 in keys of few rows.

    None if ``first`` is no number, date or time."""
    kind = df.select(as_column(first).alias("x")).schema["x"].dataType
    if isinstance(kind, TimestampType):
        number = F.unix_micros(as_column(first))
    elif isinstance(kind, TimestampNTZType):
        number = epoch_seconds(first)
    elif isinstance(kind, DateType):
        number = F.unix_date(as_column(first))
    elif isinstance(kind, NumericType):
        number = as_column(first)
    else:
        return None
    number = number.cast("double")
    own = [F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])
    large = df.groupBy(*own).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > rows_per_task)
    shares = F.array(*[F.lit(i / PIECES) for i in range(1, PIECES)])
    # a sketch a task and key, for large keys only: there are at most rows / rows_per_task of them
    points = (
        df.join(large, same_key, "left_semi")
        .groupBy(*own)
        .agg(F.percentile_approx(number, shares, 20 * PIECES).alias("_points"))
    )
    reached = F.size(F.filter("_points", lambda p: p <= number))
    return df.join(points, same_key, "left").select(*df.columns, F.when(F.col("_points").isNull(), 0).otherwise(reached).alias("_slice"))


def gaps(df: DataFrame, keys: Sequence[str], time: str, label: str | None = None) -> DataFrame:
    """Positive gaps between consecutive times of a key: ``gap_seconds`` per later time.

    Rows at the same time have no gap between them, so each key is reduced to its distinct
    times before the window sorts it. A key then holds at most one row per second of the
    time axis, however many departures it has. NULL times drop; NULL keys are a key.
    ``label`` keeps the smallest value of that column among the rows of the later time.
    """
    times = df.filter(F.col(time).isNotNull())
    if label is None:
        times = times.select(*keys, time).distinct()
    else:
        times = times.groupBy(*keys, time).agg(F.min(label).alias(label))
    previous = F.lag(time).over(Window.partitionBy(*keys).orderBy(time))
    return times.withColumn("gap_seconds", F.col(time) - previous).filter(
        F.col("gap_seconds").isNotNull()
    )


def partial_gap_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Minimum, maximum, sum and count of ``gap_seconds`` per key; see :func:`gap_stats`."""
    return df.groupBy(*keys).agg(
        F.min("gap_seconds").alias("_min"),
        F.max("gap_seconds").alias("_max"),
        F.sum("gap_seconds").alias("_sum"),
        F.count("gap_seconds").alias("_count"),
    )


def gap_stats(partial: DataFrame, by: Sequence[str]) -> DataFrame:
    """Merge :func:`partial_gap_stats` rows to whole-minute statistics per ``by``.

    Sums are whole seconds, so the mean does not depend on the order of the rows.
    """
    seconds = F.sum("_sum").cast("double")
    return partial.groupBy(*by).agg(
        F.round(F.min("_min") / 60, 0).alias("minimum_waiting_time"),
        F.round(seconds / (F.sum("_count") * 60), 0).alias("average_waiting_time"),
        F.round(F.max("_max") / 60, 0).alias("maximum_waiting_time"),
    )


def headway_stats(
    departures: DataFrame,
    names: DataFrame,
    route: Sequence[str],
    direction: Sequence[str],
    time: str,
    by: Sequence[str],
) -> DataFrame:
    """Waiting-time statistics from departures, per name of a route.

    Gaps are taken within (``route``, ``direction``), reduced to one row per route, joined
    with ``names`` on ``route`` and merged per ``by``. Routes without a name drop out.
    """
    per_route = partial_gap_stats(gaps(departures, [*route, *direction], time), route)
    return gap_stats(per_route.join(names, list(route)), by)
