"""Fixed names of the schedule data set: tables, feeds, dates and labels."""

from __future__ import annotations

# The table files of a snapshot that are merged.
TABLES = (
    "agency",
    "calendar",
    "calendar_dates",
    "frequencies",
    "routes",
    "stop_times",
    "stops",
    "trips",
)

# Inclusive range of snapshot days.
FIRST_DAY = "2024-10-01"
LAST_DAY = "2025-05-31"

# The feeds of the data set.
FEEDS = (
    "KTMB",
    "Prasarana_RapidBusKL",
    "Prasarana_RapidBusKuantan",
    "Prasarana_RapidBusMrtFeeder",
    "Prasarana_RapidBusPenang",
    "Prasarana_RapidRailKL",
    "myBAS_JohorBahru",
)

RAIL_FEED = "Prasarana_RapidRailKL"
TRAIN_FEED = "KTMB"
NON_BUS_FEEDS = (TRAIN_FEED, RAIL_FEED)

# Rail line codes (first three characters of a trip id) and feeds to operators.
OPERATOR_NAMES = {
    "AGL": "LRT Ampang Line",
    "BRT": "BRT Sunway Line",
    "KGL": "MRT Kajang Line",
    "KJL": "LRT Kelana Jaya Line",
    "MRL": "KL Monorail Line",
    "PYL": "MRT Putrajaya Line",
    "SPL": "LRT Sri Petaling Line",
    "Prasarana_RapidBusKL": "Rapid Bus KL",
    "Prasarana_RapidBusKuantan": "Rapid Bus Kuantan",
}

# Names of the result tables.
ROUTES_TABLE = "route_count_per_feed"
STOPS_TABLE = "disconnected_stops_per_feed"
WAITING_TABLE = "route_waiting_time_stats"
DAY_TYPE_TABLE = "avg_trips_by_day_type"
INTERVALS_TABLE = "departure_intervals"
QUALITY_TABLE = "service_quality"
REJECTED_TABLE = "rejected_service"
