"""Text helpers: trimming, composite keys and label clean-up."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trimmed(value: ColumnOrName) -> Column:
    """The text without outer blanks; a blank text is NULL, as in the CSV reader."""
    text = F.trim(as_column(value))
    return F.when(text != "", text)


def trim_all(df: DataFrame) -> DataFrame:
    """Apply :func:`trimmed` to every string column, keeping names and order."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({name: trimmed(F.col(f"`{name}`")) for name in texts})


def key_text(*parts: ColumnOrName, sep: str = "__") -> Column:
    """Composite key as text. NULL parts are left out, so never group by this text."""
    return F.concat_ws(sep, *[as_column(p).cast("string") for p in parts])


def prefix(value: ColumnOrName, length: int) -> Column:
    """First ``length`` characters; shorter texts come back whole."""
    return F.substring(as_column(value), 1, length)


def dashed(value: ColumnOrName) -> Column:
    """Blanks become dashes."""
    return F.translate(as_column(value), " ", "-")


def field_count(line: ColumnOrName, sep: str = ",") -> Column:
    """How many fields a CSV line has; separators between quotes do not count. NULL for NULL."""
    quoted = rf'(^|{re.escape(sep)})"(?:[^"\\]|\\.|"")*"'
    bare = F.regexp_replace(as_column(line), quoted, "$1")
    return ((F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep)).cast("int") + 1
