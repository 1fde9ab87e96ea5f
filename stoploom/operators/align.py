"""Stacking tables whose columns differ."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column a table lacks is NULL there."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to stack")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def lead_with(df: DataFrame, *first: str) -> DataFrame:
    """``first`` columns, then all others in sorted order."""
    return df.select(*first, *sorted(c for c in df.columns if c not in first))


def merge_feeds(feeds: Mapping[str, DataFrame | None]) -> DataFrame | None:
    """Stack the same table of several feeds, stamped with ``feed_id`` as first column.

    Feeds that lack the table are given as None and skipped; None comes back if all do.
    """
    stamped = [
        table.withColumn("feed_id", F.lit(feed)) for feed, table in feeds.items() if table is not None
    ]
    return lead_with(stack_by_name(stamped), "feed_id") if stamped else None
