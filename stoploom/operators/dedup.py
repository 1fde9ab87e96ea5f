"""De-duplication with one fixed survivor, whatever the file order or partitioning.

All forms aggregate before the shuffle, so a key holding a large share of the rows leaves
each map task as one row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stoploom.functions.text import ColumnOrName, as_column


def distinct_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Each value once per key."""
    return df.select(*keys, value).distinct()


def _extreme_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnOrName],
    extreme: Callable[[Column], Column],
) -> DataFrame:
    rest = [name for name in df.columns if name not in keys]
    named = {c for c in order if isinstance(c, str) and c in rest}
    ranks = [
        F.col(c) if isinstance(c, str) and c in named else as_column(c).alias(f"_rank{i}")
        for i, c in enumerate(order)
    ]
    row = F.struct(*ranks, *[F.col(f"`{name}`") for name in rest if name not in named])
    kept = df.groupBy(*keys).agg(extreme(row).alias("_row"))
    return kept.select(
        *[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns]
    )


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName]) -> DataFrame:
    """Keep, per key, the row with the smallest ``order`` tuple (NULL sorts first).

    Rows that tie on ``order`` are compared on all their other columns, so the survivor is
    always the same row.
    """
    return _extreme_row(df, keys, order, F.min)


def newest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName]
) -> DataFrame:
    """Keep, per key, the row with the largest ``order`` tuple; see :func:`one_per_key`."""
    return _extreme_row(df, keys, order, F.max)


def least_per_key(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Smallest non-NULL value per key. Numbers and times stay in hash aggregation."""
    return df.groupBy(*keys).agg(F.min(value).alias(value))


def singletons(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that are alone under their key.

    A count per key decides; the row itself rides along and is unique whenever it is kept.
    No window is needed, so a crowded key never reaches a task as more than partial counts.
    """
    rest = [name for name in df.columns if name not in keys]
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.first(name).alias(name) for name in rest]
    )
    return counted.filter("_rows = 1").select(*df.columns)
