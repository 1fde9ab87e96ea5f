"""Clock times, dates and day types as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stoploom.functions.text import ColumnOrName, as_column


def clock_seconds(time: ColumnOrName) -> Column:
    """Seconds since midnight of an ``H:MM:SS`` text, as BIGINT.

    Service days run past midnight, so any hour count is legal (``25:10:00`` is 90600).
    One-digit fields are accepted. Anything else, signs and blanks included, gives NULL.
    """
    text = F.trim(as_column(time))
    parts = F.split(text, ":")
    hours, minutes, seconds = (F.get(parts, F.lit(i)).try_cast("int") for i in range(3))
    valid = text.rlike(r"^[0-9]+:[0-9]{1,2}:[0-9]{1,2}$") & hours.isNotNull() & (minutes < 60) & (seconds < 60)
    return F.when(valid, hours.cast("bigint") * 3600 + minutes * 60 + seconds)


def epoch_seconds(timestamp: ColumnOrName) -> Column:
    """Whole seconds from 1970-01-01 to a TIMESTAMP_NTZ, whatever the session zone."""
    return F.timestamp_diff(
        "SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), as_column(timestamp)
    )


def snapshot_day(text: ColumnOrName) -> Column:
    """Strict ``YYYY-MM-DD`` to DATE; other spellings and impossible dates give NULL."""
    text = F.trim(as_column(text))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def iso_weekday(day: ColumnOrName) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(as_column(day)) + 1


def day_type(day: ColumnOrName) -> Column:
    """``weekend`` for Saturday and Sunday, else ``weekday``; NULL for a NULL day."""
    number = iso_weekday(day)
    return F.when(number >= 6, "weekend").when(number < 6, "weekday")
