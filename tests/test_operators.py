import datetime

import pytest
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from stoploom.operators import (
    avg_by_day_type,
    count_rejects,
    distinct_per_group,
    distinct_values,
    gap_stats,
    gaps,
    isolated_cells,
    isolated_points,
    lag_per_group,
    lead_with,
    least_per_key,
    merge_feeds,
    newest_per_key,
    observe_rejects,
    one_per_key,
    partial_gap_stats,
    pivot_day_type,
    relabel,
    singletons,
    split_rejects,
    stack_by_name,
)


def test_distinct_per_group(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "x"), ("a", None), ("b", "x"), ("b", "y"), ("c", "z"), (None, "x"), ("d", None)],
        "feed string, name string",
    )
    result = distinct_per_group(df, "feed", "name", ["c"])
    assert [tuple(r) for r in result.collect()] == [("b", 2), ("a", 1), ("d", 0)]
    assert {r[0] for r in distinct_per_group(df, "feed", "name").collect()} == {"a", "b", "c", "d"}


def test_one_row_per_key_is_the_same_for_any_order(spark, rows):
    data = [(1, 5, "b"), (1, 5, "a"), (1, 7, "z"), (2, None, "n"), (2, 1, "m"), (None, 3, "q")]
    for part in (data, data[::-1]):
        df = spark.createDataFrame(part, "k int, t int, v string").repartition(3)
        assert rows(one_per_key(df, ["k"], ["t"])) == [(None, 3, "q"), (1, 5, "a"), (2, None, "n")]
        assert rows(newest_per_key(df, ["k"], ["t"])) == [(None, 3, "q"), (1, 7, "z"), (2, 1, "m")]
        newest_first = one_per_key(df, ["k"], [-F.col("t")])
        assert rows(newest_first) == [(None, 3, "q"), (1, 7, "z"), (2, None, "n")]
        assert rows(least_per_key(df.select("k", "t"), ["k"], "t")) == [(None, 3), (1, 5), (2, 1)]
        assert newest_first.columns == df.columns


def test_first_per_key_equals_window(spark, rows):
    df = spark.range(500).selectExpr("id % 17 AS k", "(id * 37) % 101 AS t", "id AS v")
    ranked = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("t", "v")))
    assert rows(one_per_key(df, ["k"], ["t", "v"])) == rows(ranked.filter("r = 1").drop("r"))


def test_singletons_equal_window(spark, rows):
    df = spark.range(300).selectExpr("(id * id) % 97 AS k", "CAST(id AS STRING) AS v", "id % 5 AS w")
    df = df.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) k, CAST(NULL AS STRING) v, 1L w"))
    counted = df.withColumn("n", F.count("*").over(Window.partitionBy("k")))
    alone = rows(singletons(df, ["k"]))
    assert alone == rows(counted.filter("n = 1").drop("n"))
    assert (None, None, 1) in alone


def test_distinct_values(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert rows(distinct_values(df, ["k"], "v")) == [(1, "a"), (1, "b"), (2, None)]


STOPS = [
    ("a", "3.1", "101.7"),
    ("a", "3.10", "101.7"),  # same point
    ("a", "4.001", "100.0"),
    ("a", "4.002", "100.0"),  # same cell
    ("a", "5.0", "100.0"),  # also a stop of b
    ("b", "5.0", "100.0"),
    ("b", "2.675", "7"),
    ("b", "abc", "7"),
    ("b", "", "7"),
    ("b", "NaN", "7"),
    ("b", None, "7"),
    ("c", "6.001", "1"),  # cell shared with b, but not the point
    ("b", "6.002", "1"),
]


def test_isolated_points(spark, rows):
    df = spark.createDataFrame(STOPS, "feed string, lat string, lon string")
    owner = isolated_points(df, "feed", "lat", "lon", shared="owner")
    assert [tuple(r) for r in owner.collect()] == [("a", 2), ("b", 2), ("c", 1)]
    exclude = isolated_points(df, "feed", "lat", "lon", shared="exclude")
    assert [tuple(r) for r in exclude.collect()] == [("a", 1), ("b", 1)]
    each = isolated_points(df, "feed", "lat", "lon", shared="each")
    assert [tuple(r) for r in each.collect()] == [("b", 3), ("a", 2), ("c", 1)]
    cells = rows(isolated_cells(df, "feed", "lat", "lon"))
    assert ("b", 2.68, 7.0, "2.68,7.0") in cells
    with pytest.raises(ValueError, match="shared"):
        isolated_points(df, "feed", "lat", "lon", shared="any")


@pytest.mark.parametrize("bound", [0, 3, 20, 10**9])
def test_lag_in_slices_equals_plain_lag(spark, rows, bound):
    df = spark.range(400).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 11 END AS k",
        "CASE WHEN id % 40 = 5 THEN NULL ELSE (id * 7919) % 100 END AS t",
        "id",
        "CASE WHEN id % 9 <> 0 THEN concat('v', id) END AS v",
    )
    plain = lag_per_group(df, ["k"], ["t", "id"], "v", "p")
    cut = lag_per_group(
        df, ["k"], ["t", "id"], "v", "p", slice_by=F.floor(F.col("t") / 9), rows_per_task=bound
    )
    assert cut.columns == plain.columns
    assert rows(cut) == rows(plain)


def test_lag_refuses_what_it_can_not_cut(spark):
    df = spark.range(6).selectExpr("1 AS k", "id AS t", "id AS v")
    with pytest.raises(ValueError, match="ascending"):
        lag_per_group(df, ["k"], [F.desc("t")], "v", "p", slice_by=F.col("t"))
    broken = lag_per_group(df, ["k"], ["t"], "v", "p", slice_by=F.col("t") % 2, rows_per_task=3)
    with pytest.raises(Exception, match="slice_by decreases"):
        broken.collect()


def test_lag_in_slices_with_two_keys(spark, rows):
    df = spark.range(300).selectExpr("id % 2 AS a", "id % 3 AS b", "id AS t", "id * 2 AS v")
    plain = lag_per_group(df, ["a", "b"], ["t"], "v", "p")
    cut = lag_per_group(
        df, ["a", "b"], ["t"], "v", "p", slice_by=F.floor(F.col("t") / 30), rows_per_task=10
    )
    assert rows(cut) == rows(plain)


def test_lag_ordered_by_an_expression(spark, rows):
    df = spark.range(200).selectExpr("id % 3 AS k", "id AS t", "id AS `v`")
    order = [-F.col("t")]
    plain = lag_per_group(df, ["k"], order, "v", "p")
    slices = F.floor(-F.col("t") / 25)
    cut = lag_per_group(df, ["k"], order, "v", "p", slice_by=slices, rows_per_task=10)
    assert rows(cut) == rows(plain)
    # the value may be the key or the order itself
    for value in ("k", "t"):
        plain = lag_per_group(df, ["k"], ["t"], value, "p")
        cut = lag_per_group(
            df, ["k"], ["t"], value, "p", slice_by=F.floor(F.col("t") / 25), rows_per_task=10
        )
        assert rows(cut) == rows(plain)


@pytest.mark.parametrize("kind", ["id", "CAST(id AS DOUBLE) / 3", "timestamp_seconds(id * 1800)", "CAST(timestamp_seconds(id * 1800) AS TIMESTAMP_NTZ)", "date_add(DATE'2024-01-01', CAST(id / 40 AS INT))"])
def test_large_keys_are_cut_at_sampled_points(spark, rows, kind):
    """A key of a third of the rows, null keys and times, ties; cut into tasks, equal to the plain window."""
    key = "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 101 = 0 THEN NULL ELSE id % 50 END AS k"
    df = spark.range(6000).selectExpr(key, f"nullif({kind}, {kind.replace('id', '5')}) AS t", "id", "id * 2 AS v").repartition(3)
    want = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t", "id")))
    got = lag_per_group(df, ["k"], ["t", "id"], "v", "p", rows_per_task=400)
    assert got.columns == want.columns and rows(got) == rows(want)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = got.filter("k = 1").groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) > 1 and max(r["count"] for r in spread) < 2000


def test_lag_by_texts_and_directions_is_a_plain_window(spark, rows):
    df = spark.range(60).selectExpr("id % 2 AS k", "CAST(id AS STRING) AS t", "id AS v")
    for order in (["t"], [F.desc("v")]):
        want = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy(*order)))
        assert rows(lag_per_group(df, ["k"], order, "v", "p", rows_per_task=3)) == rows(want)


def test_gaps_drop_ties_and_keep_null_keys(spark, rows):
    minutes = [("r", 300), ("r", 300), ("r", 320), ("r", 360), (None, 10), (None, 25), ("s", 5), ("r", None)]
    df = spark.createDataFrame([(k, None if m is None else m * 60) for k, m in minutes], "k string, t long")
    assert rows(gaps(df, ["k"], "t").select("k", "gap_seconds")) == [
        (None, 900),
        ("r", 1200),
        ("r", 2400),
    ]
    stats = gap_stats(partial_gap_stats(gaps(df, ["k"], "t"), ["k"]), ["k"])
    assert rows(stats) == [(None, 15.0, 15.0, 15.0), ("r", 20.0, 30.0, 40.0)]


def test_gaps_equal_row_wise_lag(spark, rows):
    df = spark.range(2000).selectExpr("id % 7 AS k", "id AS trip", "(id * 7919) % 600 AS t")
    previous = F.lag("t").over(Window.partitionBy("k").orderBy("t", "trip"))
    row_wise = df.withColumn("gap_seconds", F.col("t") - previous).filter("gap_seconds <> 0")
    assert rows(gaps(df, ["k"], "t")) == rows(row_wise.select("k", "t", "gap_seconds"))


def test_relabel_by_dict_and_by_table(spark, rows):
    df = spark.createDataFrame([("A", 1), ("Z", 2), (None, 3)], "o string, n int")
    labels = {"A": "Ampang", "B": "Sunway"}
    table = spark.createDataFrame(list(labels.items()), "key string, label string")
    expected = [(None, 3), ("Ampang", 1), ("Z", 2)]
    assert rows(relabel(df, "o", labels)) == expected
    assert rows(relabel(df, "o", table)) == expected
    assert rows(relabel(df, "o", {})) == rows(df)


def test_day_type_means(spark):
    day = datetime.date
    df = spark.createDataFrame(
        [
            ("a", day(2024, 10, 4), 1),
            ("a", day(2024, 10, 7), 1),
            ("a", day(2024, 10, 7), 1),  # weekday totals 1 and 2
            ("a", day(2024, 10, 5), -2),
            ("a", day(2024, 10, 6), -3),  # weekend totals -2 and -3
            ("b", day(2024, 10, 8), 4),
            ("b", day(2024, 10, 9), None),  # no value: not a day
            ("c", day(2024, 10, 9), None),
            ("c", None, 9),
        ],
        "o string, d date, n int",
    )
    truncated = avg_by_day_type(df, "o", "d", "n")
    assert [tuple(r) for r in truncated.collect()] == [
        ("a", "weekday", 1),
        ("a", "weekend", -2),
        ("b", "weekday", 4),
    ]
    rounded = avg_by_day_type(df, "o", "d", "n", "half_up")
    assert [r[2] for r in rounded.collect()] == [2, -2, 4]
    wide = pivot_day_type(truncated, "o")
    assert wide.columns == ["o", "weekday_avg_daily_trips", "weekend_avg_daily_trips"]
    assert [tuple(r) for r in wide.collect()] == [("a", 1, -2), ("b", 4, None)]
    assert [tuple(r) for r in pivot_day_type(truncated, "o", fill=0).collect()][1] == ("b", 4, 0)
    with pytest.raises(ValueError, match="rounding"):
        avg_by_day_type(df, "o", "d", "n", "up")


def test_rejects(spark, rows):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (-5, "c"), (2, None)], "n int, s string")
    rules = {"no_number": F.col("n").isNull(), "no_text": F.col("s").isNull(), "odd": F.col("n") > 9}
    notes = {"negative": F.col("n") < 0}
    accepted, rejected = split_rejects(df, rules)
    assert rows(accepted) == [(-5, "c"), (1, "a")]
    assert rows(rejected) == [(None, "b", "no_number"), (2, None, "no_text")]
    expected = {"rows": 4, "no_number": 1, "no_text": 1, "odd": 0, "negative": 1, "accepted": 2}
    assert count_rejects(df, rules, notes).head().asDict() == expected
    observation = Observation("rejects")
    assert rows(observe_rejects(df, rules, observation, notes)) == rows(accepted)
    assert observation.get == expected


def test_two_splits_in_one_query(spark, rows):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "n int, s string")
    right = spark.createDataFrame([(1, 5), (1, -5)], "n int, m int")
    good_left, bad_left = split_rejects(left, {"no_number": F.col("n").isNull()})
    good_right, bad_right = split_rejects(right, {"negative": F.col("m") < 0})
    assert rows(good_left.join(good_right, "n")) == [(1, "a", 5)]
    reasons = bad_left.select("reject_reason").unionByName(bad_right.select("reject_reason"))
    assert rows(reasons) == [("negative",), ("no_number",)]


def test_stacking(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([("y", 2, 9)], "name string, id int, extra int")
    stacked = stack_by_name([a, b])
    assert rows(stacked) == [(1, "x", None), (2, "y", 9)]
    assert lead_with(stacked, "name").columns == ["name", "extra", "id"]
    merged = merge_feeds({"fa": a, "none": None, "fb": b})
    assert merged.columns == ["feed_id", "extra", "id", "name"]
    assert rows(merged) == [("fa", None, 1, "x"), ("fb", 9, 2, "y")]
    assert merge_feeds({"none": None}) is None
    with pytest.raises(ValueError, match="nothing"):
        stack_by_name([])


def test_relabel_never_multiplies_rows(spark, rows):
    names = spark.createDataFrame([("a", "A2"), ("a", "A1"), ("b", None), (None, "N")], "key string, label string")
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "x string")
    assert rows(relabel(df, "x", names)) == [(None,), (None,), ("A1",), ("A1",), ("c",)]
