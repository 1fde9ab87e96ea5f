"""Points that have no other point in their cell of a rounded coordinate grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stoploom.functions.numbers import as_double, grid_cell
from stoploom.functions.text import key_text


def isolated_cells(
    df: DataFrame, group: str, x: str, y: str, digits: int = 2, shared: str = "owner"
) -> DataFrame:
    """One row (group, ``cell_x``, ``cell_y``, ``cell``) per isolated point.

    Coordinates are parsed and compared as numbers; unparseable, blank and NaN ones drop.
    ``cell`` is the cell as text and is for output only.

    A coordinate used by several groups counts as one point. ``shared`` says whose:

    * ``owner``: it belongs to the smallest group that has it;
    * ``each``: every group has it;
    * ``exclude``: every group has it, and cells isolated in several groups are left out.
    """
    if shared not in ("owner", "each", "exclude"):
        raise ValueError(f"shared must be 'owner', 'each' or 'exclude', not {shared!r}")
    points = (
        df.select(group, as_double(x).alias("_x"), as_double(y).alias("_y"))
        .na.drop(subset=["_x", "_y"])
        .distinct()
    )
    if shared == "owner":
        # Snapshots repeat a coordinate hundreds of times. The distinct above removes the
        # repeats by hashing; comparing names needs sorting, so it should see the rest only.
        # Written as min_by because Spark drops a distinct below min.
        points = points.groupBy("_x", "_y").agg(F.min_by(group, group).alias(group))
    alone = (
        points.groupBy(
            group, grid_cell("_x", digits).alias("cell_x"), grid_cell("_y", digits).alias("cell_y")
        )
        .agg(F.count(F.lit(1)).alias("_points"))
        .filter("_points = 1")
        .drop("_points")
    )
    if shared == "exclude":
        alone = (
            alone.groupBy("cell_x", "cell_y")
            .agg(F.count(F.lit(1)).alias("_groups"), F.min(group).alias(group))
            .filter("_groups = 1")
        )
    return alone.select(
        group, "cell_x", "cell_y", key_text("cell_x", "cell_y", sep=",").alias("cell")
    )


def isolated_points(
    df: DataFrame,
    group: str,
    x: str,
    y: str,
    digits: int = 2,
    shared: str = "owner",
    out: str = "stop_count",
) -> DataFrame:
    """Number of isolated points per group, largest first. See :func:`isolated_cells`."""
    counts = (
        isolated_cells(df, group, x, y, digits, shared)
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias(out))
    )
    return counts.orderBy(F.desc(out), F.asc(group))
