"""Analyses against plain loops over small random tables."""

import math
import random
from collections import defaultdict

import pytest

from stoploom import plans
from stoploom.operators import isolated_points


def half_up(x):
    return float(math.floor(x + 0.5))


def seconds(text):
    parts = (text or "").strip().split(":")
    if len(parts) != 3 or not all(p.isdigit() for p in parts):
        return None
    h, m, s = map(int, parts)
    return h * 3600 + m * 60 + s if m < 60 and s < 60 else None


def expected_waits(routes, trips, stop_times, feed):
    names = {}
    for day, route, name in sorted((d, r, n) for f, d, r, n in routes if f == feed):
        # newest day; among its names the smallest
        if route not in names or names[route][0] < day:
            names[route] = (day, name)
    first = {}
    for f, _, trip, time in stop_times:
        at = seconds(time)
        if f == feed and at is not None:
            first[trip] = min(at, first.get(trip, at))
    served = {(r, t, d) for f, _, r, t, d in trips if f == feed}
    departures = defaultdict(list)
    for route, trip, direction in served:
        if trip in first and route in names:
            departures[route, direction].append(first[trip])
    waits = defaultdict(list)
    for (route, _), times in departures.items():
        times.sort()
        waits[names[route][1]] += [(b - a) / 60 for a, b in zip(times, times[1:]) if b > a]
    return {
        n: (half_up(min(w)), half_up(sum(w) / len(w)), half_up(max(w))) for n, w in waits.items() if w
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_waiting_time(spark, seed):
    rnd = random.Random(seed)
    days = ["2024-10-01", "2024-10-02", "2024-10-03"]
    feeds = ["KTMB", "KTMB", "other"]
    routes = [
        (rnd.choice(feeds), rnd.choice(days), f"R{rnd.randrange(9)}", f"N{rnd.randrange(5)}")
        for _ in range(30)
    ]
    trips = [
        (
            rnd.choice(feeds),
            rnd.choice(days),
            f"R{rnd.randrange(10)}",
            f"T{rnd.randrange(120)}",
            rnd.choice(["0", "1", None]),
        )
        for _ in range(400)
    ]
    dirt = [None, "", "7:00", "x:00:00", "7:61:00"]
    stop_times = [
        (
            rnd.choice(feeds),
            rnd.choice(days),
            f"T{rnd.randrange(130)}",
            rnd.choice(dirt)
            if rnd.random() < 0.2
            else f"{rnd.randrange(4, 27)}:{rnd.randrange(0, 60, 7):02d}:{rnd.choice([0, 20, 40]):02d}",
        )
        for _ in range(600)
    ]
    names = "feed_id string, subdir string, "
    result = plans.waiting_time(
        spark.createDataFrame(routes, names + "route_id string, route_short_name string"),
        spark.createDataFrame(trips, names + "route_id string, trip_id string, direction_id string"),
        spark.createDataFrame(stop_times, names + "trip_id string, departure_time string"),
    )
    found = {r[0]: tuple(r)[1:] for r in result.collect()}
    assert found == expected_waits(routes, trips, stop_times, "KTMB")
    assert len(found) > 2


def expected_isolated(points, shared):
    owners = defaultdict(set)
    for feed, x, y in points:
        owners[float(x), float(y)].add(feed)
    cells = defaultdict(list)
    for (x, y), feeds in owners.items():
        for feed in [min(feeds)] if shared == "owner" else feeds:
            cells[feed, half_up(x), half_up(y)].append((x, y))
    alone = [key for key, members in cells.items() if len(members) == 1]
    if shared == "exclude":
        alone = [
            k for k in alone if not any(o[0] != k[0] and o[1:] == k[1:] for o in alone)
        ]
    counts = defaultdict(int)
    for feed, _, _ in alone:
        counts[feed] += 1
    return sorted(counts.items(), key=lambda item: (-item[1], item[0]))


@pytest.mark.parametrize("shared", ["owner", "each", "exclude"])
def test_isolated_points(spark, shared):
    rnd = random.Random(7)
    points = [
        (rnd.choice("abcd"), f"{rnd.randrange(0, 80) / 4}", f" {rnd.randrange(0, 12) / 2}0")
        for _ in range(500)
    ]
    df = spark.createDataFrame(points, "feed string, x string, y string")
    result = isolated_points(df, "feed", "x", "y", 0, shared)
    assert [tuple(r) for r in result.collect()] == expected_isolated(points, shared)
