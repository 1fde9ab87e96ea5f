"""One type for a text column from all of its values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stoploom.functions.text import ColumnOrName, as_column

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_DAY = r"^\s*\d{4}-\d{2}-\d{2}\s*$"
_TIME = r"^\s*\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?\s*$"
#: Types from narrow to wide, and the spelling a value of the type has.
TYPES = {
    "int": r"^\s*[+-]?\d+\s*$",
    "bigint": r"^\s*[+-]?\d+\s*$",
    "double": _NUMBER,
    "date": _DAY,
    "timestamp_ntz": _TIME,
    "boolean": r"(?i)^\s*(true|false)\s*$",
}


def fits(value: ColumnOrName, kind: str) -> Column:
    """Whether a text is NULL or reads as a value of ``kind``."""
    text = as_column(value)
    return text.isNull() | (text.rlike(TYPES[kind]) & text.try_cast(kind).isNotNull())


def common_types(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The narrowest type that all values of each text column fit, ``string`` if there is none or no value.

    One pass; partial answers of tasks are merged, so the result depends on no order and no partitioning."""
    checks = [F.bool_and(fits(F.col(f"`{c}`"), k)).alias(f"{i}_{k}") for i, c in enumerate(columns) for k in TYPES]
    some = [F.count(F.col(f"`{c}`")).alias(f"{i}_n") for i, c in enumerate(columns)]
    if not columns:
        return {}
    found = df.agg(*checks, *some).first()
    return {c: next((k for k in TYPES if found[f"{i}_n"] and found[f"{i}_{k}"]), "string") for i, c in enumerate(columns)}


def with_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with its text ``columns`` cast to their :func:`common_types`; other columns and the order stay."""
    kinds = common_types(df, columns)
    return df.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])
