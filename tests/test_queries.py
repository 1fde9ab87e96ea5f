import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks import frames
from checks.compare import differences, normalized
from checks.oracle import ORACLE
from checks.queries import QUERIES
from stoploom import plans

SMALL = "/root/testdata/sf0.001"


WRITING = ("merge_snapshots", "merge_tables", "csv_scan_inferred", "csv_short_rows", "csv_one_file", "table_if_database", "publish_report")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), SMALL, ORACLE[name]) is None


def test_contract(spark):
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys() and ORACLE.keys() <= contract.oracle_sql().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert contract.entry(spark).count() > 0


def shuffled(df, seed):
    return df.orderBy(F.rand(seed)).repartition(5)


@pytest.mark.parametrize("partitions", [1, 16])
def test_results_do_not_depend_on_order_or_partitions(spark, partitions):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)

    def answers(arrange):
        train = [
            arrange(f(spark, SMALL))
            for f in (frames.train_routes, frames.train_trips, frames.train_stop_times)
        ]
        frequencies = arrange(frames.frequencies(spark, SMALL))
        stops = arrange(frames.stops(spark, SMALL))
        results = [
            plans.waiting_time(*train),
            plans.departure_intervals(*train),
            plans.average_trips(frequencies),
            plans.disconnected_stops(stops),
            plans.disconnected_stops(stops, shared="exclude"),
            plans.routes_per_feed(arrange(frames.routes(spark, SMALL))),
        ]
        return [normalized(df.columns, [tuple(r) for r in df.collect()]) for df in results]

    expected = answers(lambda df: df)
    try:
        spark.conf.set(key, partitions)
        assert answers(lambda df: shuffled(df, partitions)) == expected
    finally:
        spark.conf.set(key, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_keep_filters_and_columns_at_the_scan(spark, tmp_path):
    path = str(tmp_path / "stop_times")
    frames.train_stop_times(spark, SMALL).withColumn("unused", F.lit("x")).write.parquet(path)
    stop_times = spark.read.parquet(path)
    plan = plan_of(plans.first_departures(frames.train_trips(spark, SMALL), stop_times, "KTMB"))
    scans = [line for line in plan.splitlines() if "unused" in line or "departure_time" in line]
    assert any("EqualTo(feed_id,KTMB)" in line for line in scans)
    assert not re.search(r"ReadSchema: struct<[^>]*(unused|subdir)", plan)


def test_plans_hold_no_cross_join_and_no_python(spark):
    for name, query in QUERIES.items():
        if name in WRITING:
            continue
        plan = plan_of(query(spark, SMALL))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
            assert operator not in plan, (name, operator)
        if name not in ("reject_counts", "service_quality"):  # these sum to one row of counts
            assert "SinglePartition" not in plan, name


def test_pivot_sorts_once_and_rejects_scan_once(spark):
    assert plan_of(plans.average_trips_wide(frames.frequencies(spark, SMALL))).count("rangepartitioning") == 1
    assert plan_of(QUERIES["split_rejects"](spark, SMALL)).count("FileScan") == 1


def test_hot_values_leave_each_map_task_as_partial_aggregates(spark):
    """The first shuffle of each analysis carries aggregates, not rows."""
    stops = plan_of(plans.disconnected_stops(frames.stops(spark, SMALL)))
    average = plan_of(plans.average_trips(frames.frequencies(spark, SMALL)))
    routes = plan_of(plans.routes_per_feed(frames.routes(spark, SMALL)))
    for plan in (stops, average, routes):
        lines = plan.splitlines()
        last = max(i for i, line in enumerate(lines) if "Exchange" in line)
        assert "HashAggregate" in lines[last + 1]
        assert "SortAggregate" not in lines[last + 1]


def test_sources_name_no_machine_local_checkpoint():
    root = Path(contract.__file__).parent
    for path in [*root.glob("stoploom/**/*.py"), *root.glob("checks/*.py")]:
        assert "localCheckpoint" not in path.read_text()
