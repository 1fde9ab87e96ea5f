"""Setting dirty rows aside and counting them by reason."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REASON = "reject_reason"


def tag_rejects(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``reject_reason``: the first rule that holds for the row, or NULL.

    ``rules`` maps a reason to the condition under which a row is rejected.
    """
    reasons = [F.when(condition, F.lit(name)) for name, condition in rules.items()]
    return df.withColumn(REASON, F.coalesce(*reasons))


def _counters(rules: Mapping[str, Column], notes: Mapping[str, Column]) -> list[Column]:
    counters = [F.count(F.lit(1)).alias("rows")]
    counters += [F.count_if(F.col(REASON) == name).alias(name) for name in rules]
    counters += [F.count_if(condition).alias(name) for name, condition in notes.items()]
    counters.append(F.count_if(F.col(REASON).isNull()).alias("accepted"))
    return counters


def split_rejects(
    df: DataFrame, rules: Mapping[str, Column], name: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their ``reject_reason``).

    Query listeners get the counts of :func:`count_rejects` under ``name`` (by default a new
    one, as a query may hold each name once). The metric also
    keeps Spark from moving the filter below the rules: there it would compute the columns
    the rules look at once more per use, which costs several times the rest of the scan.
    """
    name = name or f"rejects-{uuid.uuid4().hex}"
    tagged = tag_rejects(df, rules).observe(name, *_counters(rules, {}))
    accepted = tagged.filter(F.col(REASON).isNull()).drop(REASON)
    return accepted, tagged.filter(F.col(REASON).isNotNull())


def count_rejects(
    df: DataFrame, rules: Mapping[str, Column], notes: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row: ``rows``, a count per reason, a count per note, ``accepted``.

    ``notes`` are counted like reasons but reject nothing.
    """
    return tag_rejects(df, rules).agg(*_counters(rules, notes or {}))


def observe_rejects(
    df: DataFrame,
    rules: Mapping[str, Column],
    observation: Observation,
    notes: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Accepted rows; ``observation`` fills with the counts of :func:`count_rejects`.

    The counts come with the first action and cost no pass of their own. A task that Spark
    runs twice after a lost executor may be counted twice; for a certified number use
    :func:`count_rejects`.
    """
    tagged = tag_rejects(df, rules).observe(observation, *_counters(rules, notes or {}))
    return tagged.filter(F.col(REASON).isNull()).drop(REASON)
