"""Numeric parsing and rounding that never stops a job on a dirty value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stoploom.functions.text import ColumnOrName, as_column


def as_double(value: ColumnOrName) -> Column:
    """The value as DOUBLE, or NULL when the text is not a number."""
    return as_column(value).try_cast("double")


def grid_cell(value: ColumnOrName, digits: int) -> Column:
    """Half-up rounding to ``digits`` places: the edge of a grid cell."""
    return F.round(as_column(value), digits)


def truncated_ratio(numerator: ColumnOrName, divisor: ColumnOrName) -> Column:
    """``numerator / divisor`` cut towards zero to BIGINT.

    A zero divisor or a quotient outside BIGINT gives NULL.
    """
    ratio = F.try_divide(as_column(numerator).cast("double"), as_column(divisor).cast("double"))
    return ratio.try_cast("bigint")
