"""The analyses over merged schedule tables.

Each takes the merged tables as DataFrames (all columns text, ``feed_id`` and the dated
folder ``subdir`` on every row) and returns the result; the caller shows or saves it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stoploom.functions.clock import clock_seconds, snapshot_day
from stoploom.functions.numbers import as_double
from stoploom.functions.text import dashed, key_text
from stoploom.operators.daytype import (
    avg_by_day_type,
    pivot_day_type,
    relabel,
    switch_to_prefix,
    trips_from_headway,
)
from stoploom.operators.dedup import one_per_key
from stoploom.operators.distinct import distinct_per_group
from stoploom.operators.gaps import gaps, headway_stats
from stoploom.operators.isolated import isolated_points
from stoploom.operators.quality import count_rejects, observe_rejects, split_rejects
from stoploom.plans.schedule import NON_BUS_FEEDS, OPERATOR_NAMES, RAIL_FEED, TRAIN_FEED
from stoploom.sinks.counted import Written, write_counted


def routes_per_feed(routes: DataFrame, exclude: Sequence[str] = NON_BUS_FEEDS) -> DataFrame:
    """How many distinct long route names each bus feed has: ``feed_id, route_count``."""
    return distinct_per_group(routes, "feed_id", "route_long_name", exclude, "route_count")


def disconnected_stops(stops: DataFrame, digits: int = 2, shared: str = "owner") -> DataFrame:
    """How many stops have no other stop of their feed in their cell of about 1 km.

    ``feed_id, stop_count``; see :func:`stoploom.operators.isolated_cells` for ``shared``.
    """
    return isolated_points(stops, "feed_id", "stop_lat", "stop_lon", digits, shared, "stop_count")


def _day_of(table: DataFrame) -> Column:
    """Snapshot day: the typed partition column of a merged table, else the folder's name."""
    return F.col("snapshot_date") if "snapshot_date" in table.columns else snapshot_day("subdir")


def route_names(
    routes: DataFrame, feed: str, by_snapshot: bool = False, dash: bool = False
) -> DataFrame:
    """One ``route_short_name`` per ``route_id``: the newest one, ties by smallest name.

    ``by_snapshot`` gives one per route and ``subdir``; ``dash`` turns blanks into dashes.
    """
    mine = routes.filter((F.col("feed_id") == feed) & F.col("route_id").isNotNull())
    name = [F.col("route_short_name").isNull(), "route_short_name"]
    if by_snapshot:
        named = mine.select("route_id", "subdir", "route_short_name")
        named = one_per_key(named, ["route_id", "subdir"], name)
    else:
        age = -F.unix_date(_day_of(routes))
        named = mine.select("route_id", "route_short_name", age.alias("age"))
        named = one_per_key(named, ["route_id"], [F.col("age").isNull(), "age", *name]).drop("age")
    if dash:
        named = named.withColumn("route_short_name", dashed("route_short_name"))
    return named


def first_departures(
    trips: DataFrame, stop_times: DataFrame, feed: str, by_snapshot: bool = False
) -> DataFrame:
    """First departure of every trip, in seconds of the service day.

    ``route_id, direction_id, trip_id[, subdir], departure``. Snapshots are pooled, so a trip
    that is listed on many days counts once; with ``by_snapshot`` every day counts.
    A trip under several routes or directions is kept for each. Trips without a readable
    departure time drop out.
    """
    stamp = ["subdir"] if by_snapshot else []
    # grouped by the key of the join, so that one exchange serves both; partial sets leave the map tasks
    served = (
        trips.filter((F.col("feed_id") == feed) & F.col("trip_id").isNotNull())
        .groupBy("trip_id", *stamp)
        .agg(F.collect_set(F.struct("route_id", "direction_id")).alias("served"))
    )
    first = (
        stop_times.filter(F.col("feed_id") == feed)
        .select("trip_id", *stamp, clock_seconds("departure_time").alias("departure"))
        .groupBy("trip_id", *stamp)
        .agg(F.min("departure").alias("departure"))
        .filter(F.col("departure").isNotNull())
    )
    return served.join(first, ["trip_id", *stamp]).select("trip_id", *stamp, F.inline("served"), "departure")


def departure_intervals(
    routes: DataFrame,
    trips: DataFrame,
    stop_times: DataFrame,
    feed: str = TRAIN_FEED,
    by_snapshot: bool = False,
) -> DataFrame:
    """The gaps behind :func:`waiting_time`, one row per later departure.

    ``route_trip_direction_id, route_direction_id, route_short_name, departure,
    interval_in_minutes[, subdir]``. Of trips that leave together the smallest id is named.
    """
    stamp = ["subdir"] if by_snapshot else []
    rows = gaps(
        first_departures(trips, stop_times, feed, by_snapshot),
        ["route_id", "direction_id", *stamp],
        "departure",
        label="trip_id",
    )
    named = rows.join(route_names(routes, feed, by_snapshot), ["route_id", *stamp])
    return named.select(
        key_text("route_id", "trip_id", "direction_id").alias("route_trip_direction_id"),
        key_text("route_id", "direction_id").alias("route_direction_id"),
        "route_short_name",
        "departure",
        (F.col("gap_seconds") / 60).alias("interval_in_minutes"),
        *stamp,
    )


def waiting_time(
    routes: DataFrame,
    trips: DataFrame,
    stop_times: DataFrame,
    feed: str = TRAIN_FEED,
    by_snapshot: bool = False,
    dash: bool = False,
) -> DataFrame:
    """Minimum, average and maximum minutes between consecutive departures per route.

    Routes are named last: by then there is one row of sums per route, so the name table
    meets a handful of rows instead of all trips.
    """
    stamp = ["subdir"] if by_snapshot else []
    return headway_stats(
        first_departures(trips, stop_times, feed, by_snapshot),
        route_names(routes, feed, by_snapshot, dash),
        route=["route_id", *stamp],
        direction=["direction_id"],
        time="departure",
        by=["route_short_name", *stamp],
    )


#: The column of :func:`stoploom.sources.read_csv_table` and ``merge_all`` that the analyses know: lines with too
#: few or too many fields.
ROW_FAULT = "row_fault"


def service_rules(faults: bool = False) -> dict[str, Column]:
    """Conditions under which a row of :func:`service_windows` is rejected; with ``faults`` short lines come first."""
    headway = F.col("headway")
    short = {"short_row": F.col(ROW_FAULT) == "short_row"} if faults else {}
    return short | {
        "bad_date": F.col("snapshot_day").isNull(),
        "bad_time": F.col("duration").isNull(),
        "bad_headway": headway.isNull() | F.isnan(headway),
        "zero_headway": headway == 0,
    }


def service_notes(faults: bool = False) -> dict[str, Column]:
    """Conditions that are counted but reject nothing: fields behind the last one are not read."""
    long = {"long_row": F.col(ROW_FAULT) == "long_row"} if faults else {}
    return long | {"negative_duration": F.col("duration") < 0}


def service_windows(
    frequencies: DataFrame, names: Mapping[str, str] | DataFrame = OPERATOR_NAMES
) -> DataFrame:
    """Frequency rows as ``operator_name, snapshot_day, duration, headway, num_trips``.

    The rail feed is split by line: the first three characters of the trip id.
    Values that cannot be read are NULL; see :func:`service_rules`.
    """
    typed = frequencies.select(
        F.col("feed_id").alias("operator_name"),
        "trip_id",
        _day_of(frequencies).alias("snapshot_day"),
        (clock_seconds("end_time") - clock_seconds("start_time")).alias("duration"),
        as_double("headway_secs").alias("headway"),
        *([ROW_FAULT] if ROW_FAULT in frequencies.columns else []),
    )
    by_line = switch_to_prefix(typed, "operator_name", RAIL_FEED, "trip_id", 3).drop("trip_id")
    return trips_from_headway(relabel(by_line, "operator_name", names), "duration", "headway")


def average_trips(
    frequencies: DataFrame,
    rounding: str = "truncate",
    names: Mapping[str, str] | DataFrame = OPERATOR_NAMES,
    observation: Observation | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Mean daily trips per operator and day type: ``operator_name, day_type, avg_daily_trips``.

    Rows that cannot be read are left out; an ``observation`` receives their counts.
    """
    windows = service_windows(frequencies, names)
    faults = ROW_FAULT in windows.columns
    if observation is not None:
        windows = observe_rejects(windows, service_rules(faults), observation, service_notes(faults))
    # A rejected row has no day or no number of trips and so adds nothing. Filtering it
    # here would only make Spark parse the texts twice. Short lines may have both and are told not to count.
    if faults:
        whole = ~F.col(ROW_FAULT).eqNullSafe("short_row")
        windows = windows.withColumn("num_trips", F.when(whole, F.col("num_trips")))
    return avg_by_day_type(windows, "operator_name", "snapshot_day", "num_trips", rounding, ordered=ordered)


def average_trips_wide(
    frequencies: DataFrame,
    rounding: str = "truncate",
    names: Mapping[str, str] | DataFrame = OPERATOR_NAMES,
    fill: int | None = None,
) -> DataFrame:
    """:func:`average_trips` with a column per day type."""
    averages = average_trips(frequencies, rounding, names, ordered=False)
    return pivot_day_type(averages, "operator_name", fill=fill)


def service_quality(frequencies: DataFrame) -> DataFrame:
    """One row of counts: rows, rejected rows by reason, negative windows, accepted rows."""
    windows = service_windows(frequencies)
    faults = ROW_FAULT in windows.columns
    return count_rejects(windows, service_rules(faults), service_notes(faults))


def save_service(frequencies: DataFrame, path: str) -> Written:
    """Service windows written in one pass: accepted ones, rejected ones with their reason, and the counts of
    :func:`service_quality`, which stay exact if tasks are run again."""
    windows = service_windows(frequencies)
    faults = ROW_FAULT in windows.columns
    return write_counted(windows, path, service_rules(faults), service_notes(faults))


def rejected_service(frequencies: DataFrame) -> DataFrame:
    """The rows :func:`average_trips` leaves out, with their ``reject_reason``."""
    windows = service_windows(frequencies)
    return split_rejects(windows, service_rules(ROW_FAULT in windows.columns))[1]
