"""Whole jobs: the merge of snapshots and the analyses over merged tables."""

from stoploom.plans.analyses import (
    average_trips,
    average_trips_wide,
    departure_intervals,
    disconnected_stops,
    first_departures,
    rejected_service,
    route_names,
    routes_per_feed,
    save_service,
    service_quality,
    waiting_time,
)
from stoploom.plans.merge import merge_schedule

__all__ = [
    "average_trips",
    "average_trips_wide",
    "departure_intervals",
    "disconnected_stops",
    "first_departures",
    "merge_schedule",
    "rejected_service",
    "route_names",
    "routes_per_feed",
    "save_service",
    "service_quality",
    "waiting_time",
]
