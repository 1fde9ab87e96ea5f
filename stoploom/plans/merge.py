"""The merge job: from a tree of dated feed folders to one partitioned table per file kind."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from stoploom.plans.schedule import FEEDS, FIRST_DAY, LAST_DAY, TABLES
from stoploom.sinks.writers import write_csv, write_partitioned
from stoploom.sources.snapshots import merge_all


def merge_schedule(
    spark: SparkSession,
    root: str,
    target: str,
    tables: Sequence[str] = TABLES,
    feeds: Sequence[str] | None = FEEDS,
    first_day: date | str | None = FIRST_DAY,
    last_day: date | str | None = LAST_DAY,
    fmt: str = "parquet",
    only_touched: bool = False,
) -> list[str]:
    """Write ``<target>/<table>`` for every table that has data; returns their names.

    ``parquet`` folders are partitioned by feed and snapshot date, ``csv`` ones are plain
    headered files with ``feed_id, subdir`` first. The list of files merged stays as ``<target>/_manifest``.
    With ``only_touched`` folders of feeds and dates outside of this merge stay as they are
    (``parquet`` only), so that a new day can be added to an archive.
    """
    if only_touched and fmt != "parquet":
        raise ValueError("only_touched needs the partitioned format, parquet")
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"fmt must be 'parquet' or 'csv', not {fmt!r}")
    merged = merge_all(spark, root, tables, feeds, first_day, last_day, store=f"{target.rstrip('/')}/_manifest")
    for table, df in merged.items():
        if fmt == "parquet":
            write_partitioned(df, f"{target}/{table}", only_touched=only_touched)
        else:
            write_csv(df.drop("snapshot_date"), f"{target}/{table}")
    return list(merged)
