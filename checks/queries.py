"""Registered queries: every operator and every analysis, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import frames
from checks.frames import scratch, star
from stoploom import plans
from stoploom.functions import (
    clock_seconds,
    dashed,
    epoch_seconds,
    key_text,
    trimmed,
)
from stoploom.operators import (
    avg_by_day_type,
    count_rejects,
    daily_sum,
    distinct_per_group,
    distinct_values,
    headway_stats,
    isolated_points,
    lag_per_group,
    least_per_key,
    merge_feeds,
    newest_per_key,
    one_per_key,
    pivot_day_type,
    relabel,
    singletons,
    switch_to_prefix,
    tag_rejects,
    trips_from_headway,
)
from stoploom.sinks import publish, save_table_if_db, write_csv
from stoploom.sources import merge_snapshots as merge_tree
from stoploom.sources import read_csv_table, read_table


def distinct_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = star(spark, sf_dir, "part")
    return distinct_per_group(part, "p_brand", "p_type", ["Brand#1", "Brand#2"], "type_count")


def _customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir, "customer").select(
        "c_mktsegment", "c_acctbal", (F.col("c_nationkey") * 100).alias("north")
    )


def isolated_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _customer_points(spark, sf_dir)
    return isolated_points(points, "c_mktsegment", "c_acctbal", "north", -2, "owner", "points")


def isolated_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _customer_points(spark, sf_dir)
    return isolated_points(points, "c_mktsegment", "c_acctbal", "north", -2, "exclude", "points")


def isolated_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _customer_points(spark, sf_dir)
    return isolated_points(points, "c_mktsegment", "c_acctbal", "north", -2, "each", "points")


def window_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        "o_orderpriority",
    )
    return singletons(orders, ["o_custkey", "year", "month"])


def dedup_group_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = distinct_values(star(spark, sf_dir, "lineitem"), ["l_partkey"], "l_suppkey")
    return pairs.groupBy("l_partkey").agg(F.count("l_suppkey").alias("suppliers"))


def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority"
    )
    first = one_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return newest_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


def lag_previous(
    spark: SparkSession, sf_dir: str, slice_seconds: int = 60, **bound: int
) -> DataFrame:
    events = star(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    lagged = lag_per_group(
        events,
        ["user_id"],
        ["ts", "event_id"],
        "event_id",
        "previous_event_id",
        slice_by=F.floor(epoch_seconds("ts") / slice_seconds),
        **bound,
    )
    return lagged.drop("ts")


def lag_previous_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a bound so low that most users are cut into days."""
    return lag_previous(spark, sf_dir, slice_seconds=86400, rows_per_task=50)


def lag_previous_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without a place to cut: users of more than 50 events are cut at sampled quantiles of the time."""
    events = star(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    lagged = lag_per_group(events, ["user_id"], ["ts", "event_id"], "event_id", "previous_event_id", rows_per_task=50)
    return lagged.drop("ts")


def headways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations are routes, orders are trips, the first ship date is the departure."""
    customer = star(spark, sf_dir, "customer")
    orders = star(spark, sf_dir, "orders")
    first = least_per_key(
        star(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("o_orderkey"), epoch_seconds("l_shipdate").alias("departure")
        ),
        ["o_orderkey"],
        "departure",
    )
    departures = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .select("o_orderkey", "o_orderstatus", F.col("c_nationkey").alias("n_nationkey"))
        .join(first, "o_orderkey")
    )
    names = star(spark, sf_dir, "nation").select("n_nationkey", dashed("n_name").alias("n_name"))
    return headway_stats(
        departures, names, ["n_nationkey"], ["o_orderstatus"], "departure", ["n_name"]
    )


def prefix_relabel(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = star(spark, sf_dir, "part").select("p_brand", "p_type")
    switched = switch_to_prefix(part, "p_brand", "Brand#1", "p_type", 3)
    labels = {"ECO": "Economy line", "PRO": "Promo line", "Brand#2": "Second brand"}
    named = relabel(switched, "p_brand", labels)
    return named.groupBy(dashed("p_brand").alias("operator")).agg(F.count("*").alias("parts"))


def relabel_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary given as a table: nations name the customers' nation keys."""
    customer = star(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("operator")
    )
    names = star(spark, sf_dir, "nation").filter("n_regionkey <> 0")
    labels = names.select(
        F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("label")
    )
    # a key that comes twice must not multiply rows
    again = labels.select("key", F.concat("label", F.lit(" (again)")).alias("label"))
    return relabel(customer, "operator", labels.unionByName(again))


def clock_to_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = F.date_format("ts", "mm:ss")
    hour = F.hour("ts")
    text = (
        F.when(F.col("event_type") == "click", F.concat_ws(":", hour, minutes))
        .when(F.col("event_type") == "view", F.concat(F.lit("  0"), F.concat_ws(":", hour, minutes)))
        .when(F.col("event_type") == "error", F.concat_ws(":", hour + 24, minutes))
        .when(F.col("event_type") == "signup", F.lit(" "))
        .when(F.col("event_id") % 4 == 0, F.concat_ws(":", hour, F.lit("75"), F.lit("00")))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit("-"), F.concat_ws(":", F.lit("0"), minutes)))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit("+"), F.concat_ws(":", hour, minutes)))
        .otherwise(F.concat_ws(": ", hour, minutes))
    )
    events = star(spark, sf_dir, "events")
    return events.select("event_id", clock_seconds(text).alias("clock_seconds"))


def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.col("value").cast("string"), F.lit("?")))
        .when(F.col("event_type") == "signup", F.lit("   "))
        .otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
    )
    raw = star(spark, sf_dir, "events").select(trimmed(text).alias("text"), "event_type")
    typed = raw.withColumn("number", F.col("text").try_cast("double"))
    rules = {
        "blank": F.col("text").isNull(),
        "not_a_number": F.col("number").isNull(),
        "small": F.col("number") < 5,
    }
    return count_rejects(typed, rules, {"large": F.col("number") > 100})


def _daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star(spark, sf_dir, "orders").select(
        "o_orderpriority", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice"
    )
    return trips_from_headway(orders, "o_totalprice", F.lit(700))


def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_sum(
        _daily_orders(spark, sf_dir), ["o_orderpriority"], "day", "num_trips", "total_trips"
    )


def _named_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = {"1-URGENT": "Express", "5-LOW": "Local"}
    return relabel(_daily_orders(spark, sf_dir), "o_orderpriority", labels).withColumnRenamed(
        "o_orderpriority", "operator_name"
    )


def day_type_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return avg_by_day_type(_named_orders(spark, sf_dir), "operator_name", "day", "num_trips")


def day_type_mean_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return avg_by_day_type(
        _named_orders(spark, sf_dir), "operator_name", "day", "num_trips", "half_up"
    )


def day_type_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_day_type(day_type_mean(spark, sf_dir), "operator_name")


def _write_tree(rows: DataFrame, path: str) -> None:
    """One headered CSV folder per ``subdir``, added to what is there."""
    writer = rows.hint("rebalance", "subdir").write.mode("append").option("header", True)
    writer.partitionBy("subdir").csv(path)


def merge_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, written as two feeds of dated CSV folders whose headers drift, merged back."""
    events = star(spark, sf_dir, "events").withColumn(
        "subdir", F.col("ts").cast("date").cast("string")
    )
    purchases = F.col("event_type").isin("purchase", "signup")
    early = F.col("subdir") < "2024-01-16"
    root = scratch(spark, "merge")
    for feed, rows, columns in (
        ("shop", purchases & early, ["event_id", "user_id", "event_type"]),
        ("shop", purchases & ~early, ["value", "event_type", "event_id", "user_id"]),
        ("site", ~purchases & early, ["event_id", "props", "user_id", "event_type"]),
        ("site", ~purchases & ~early, ["event_id", "value", "user_id", "event_type"]),
    ):
        _write_tree(events.filter(rows).select("subdir", *columns), f"{root}/{feed}")
    # Snapshots outside the range: a copy of the purchases a year before.
    old = events.filter(purchases).withColumn("subdir", F.replace("subdir", F.lit("2024"), F.lit("2023")))
    _write_tree(old.select("subdir", "event_id"), f"{root}/shop")
    merged = merge_tree(
        spark,
        root,
        "events",
        feeds=["shop", "site", "absent"],
        first_day="2024-01-01",
        last_day="2024-01-30",
        file_glob="part-*.csv",
    )
    return merged.groupBy("feed_id", "subdir").agg(
        F.count(F.lit(1)).alias("events"),
        F.count("value").alias("with_value"),
        F.count("props").alias("with_props"),
        F.sum(F.col("user_id").try_cast("bigint")).alias("user_sum"),
        F.count_distinct("event_type").alias("event_types"),
        F.max(F.col("value").try_cast("double")).alias("max_value"),
        F.max(F.length("props")).cast("bigint").alias("longest_props"),
    )


def stacked_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = star(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    supplier = star(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation")
    )
    merged = merge_feeds({"customers": customer, "suppliers": supplier, "absent": None})
    return merged.withColumn("key", key_text("feed_id", "id", "segment"))


def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as headered CSV files and read back with inferred types."""
    target = scratch(spark, "csv")
    part = star(spark, sf_dir, "part").withColumn("note", F.concat_ws(", ", "p_type", "p_name"))
    write_csv(part.select("p_partkey", "p_size", "p_retailprice", "note"), f"{target}/part")
    table = read_csv_table(spark, f"{target}/part/*.csv", infer=True)
    return table.groupBy("note").agg(
        F.count(F.lit(1)).alias("parts"),
        F.sum(F.col("p_partkey").cast("bigint")).alias("key_sum"),
        F.max(F.col("p_size").cast("bigint")).alias("largest"),
        F.max(F.col("p_retailprice").cast("double")).alias("dearest"),
    )


def csv_short_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that end early have NULL in the fields they lack."""
    target = scratch(spark, "short")
    price = F.when(F.col("p_size") % 4 != 1, F.concat(F.lit(","), F.col("p_retailprice")))
    more = F.concat(F.lit(',"'), F.col("p_type"), F.lit(', x"'), F.coalesce(price, F.lit("")))
    line = F.concat("p_brand", F.when(F.col("p_size") % 4 != 0, more).otherwise(""))
    rows = star(spark, sf_dir, "part").select(line.alias("brand,type,price"))
    # as a one-column file whose lines are written as they are
    rows.write.option("header", True).option("quote", "\u0000").option("escapeQuotes", False).option("sep", "\u0001").csv(target)
    table = read_csv_table(spark, target)
    return table.groupBy(F.col("brand").alias("p_brand")).agg(
        F.count("*").alias("parts"),
        F.count("type").alias("with_type"),
        F.count("price").alias("with_price"),
        F.max(F.col("price").cast("double")).alias("dearest"),
    )


def _write_lines(lines: DataFrame, path: str) -> None:
    """CSV files whose lines are the texts of the one column of ``lines``, its name their header."""
    options = {"header": True, "quote": "\u0000", "escapeQuotes": False, "sep": "\u0001"}
    lines.write.options(**options).csv(path)


def csv_field_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with too few and too many fields counted by reason; separators in quotes are no fields."""
    target = scratch(spark, "guard")
    name = F.concat(F.lit('"'), F.col("p_type"), F.lit(', x"'))
    cut = F.col("p_size") % 4
    price, more = F.col("p_retailprice").cast("string"), F.when(cut == 3, F.lit('"a, b"'))
    line = F.when(cut == 0, F.col("p_brand")).when(cut == 1, F.concat_ws(",", "p_brand", name)).otherwise(F.concat_ws(",", "p_brand", name, price, more))
    _write_lines(star(spark, sf_dir, "part").select(line.alias("brand,type,price")), target)
    table = read_csv_table(spark, target, faults="fault")
    tagged = tag_rejects(table, {k: F.col("fault") == k for k in ("short_row", "long_row")})
    reason = F.coalesce("reject_reason", F.lit("accepted")).alias("reject_reason")
    return tagged.groupBy(F.col("brand").alias("p_brand"), reason).agg(
        F.count("*").alias("rows"), F.count("type").alias("with_type"), F.max(F.col("price").cast("double")).alias("dearest")
    )


def csv_one_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file, written twice to one path: the second write replaces the first."""
    target = scratch(spark, "one")
    nation = star(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", "n_name")
    write_csv(nation.unionByName(nation), target, one_file=True)
    write_csv(nation.repartition(4, "n_nationkey"), target, one_file=True)
    table = read_csv_table(spark, target, infer=True).withColumn("file", F.input_file_name())
    files = F.lit(table.select("file").distinct().count())
    named = table.groupBy(F.col("n_regionkey").cast("bigint").alias("region"))
    return named.agg(F.count("*").alias("nations"), F.min("n_name").alias("first"), F.first(files).alias("files"))


def table_if_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table saved twice, so that the second replaces the first; no table without its database."""
    spark.sql("CREATE DATABASE IF NOT EXISTS stoploom_checks")
    part = star(spark, sf_dir, "part").select("p_brand", "p_size")
    name = f"parts_{uuid.uuid4().hex}"
    save_table_if_db(part.unionByName(part), "stoploom_checks", name)
    saved = save_table_if_db(part, "stoploom_checks", name)
    elsewhere = save_table_if_db(part, "stoploom_absent", name)
    return (
        spark.table(f"stoploom_checks.{name}")
        .groupBy("p_brand")
        .agg(F.count("*").alias("parts"), F.sum(F.col("p_size").cast("bigint")).alias("sizes"))
        .withColumns({"saved": F.lit(saved), "elsewhere": F.lit(elsewhere)})
    )


def publish_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report that goes to a path whole, its database being absent."""
    target = scratch(spark, "report")
    part = star(spark, sf_dir, "part")
    report = part.groupBy(F.col("p_brand").alias("feed_id")).agg(F.count_distinct("p_type").alias("types"))
    publish(report, "types_per_brand", database="stoploom_absent", path=target)
    table = read_csv_table(spark, target).withColumn("file", F.input_file_name())
    files = table.select("file").distinct().count()
    return table.select("feed_id", F.col("types").cast("bigint").alias("types"), F.lit(files).alias("files"))


def merge_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in two feeds whose headers differ, merged with one type for each column over all files.

    One feed has whole numbers where the other has decimals, or words where the other has numbers."""
    root = scratch(spark, "inferred")
    events = star(spark, sf_dir, "events").withColumn("subdir", F.col("ts").cast("date").cast("string"))
    whole = F.col("event_id") % 2 == 0
    near = events.filter(whole).select("subdir", "event_id", F.col("value").cast("bigint").alias("amount"), F.col("user_id").alias("code"), F.col("ts").cast("date").cast("string").alias("day"))
    far = events.filter(~whole).select("subdir", F.col("event_type").alias("code"), F.col("value").alias("amount"), "event_id")
    _write_tree(near, f"{root}/near")
    _write_tree(far, f"{root}/far")
    merged = merge_tree(spark, root, "events", file_glob="part-*.csv", infer=True)
    kinds = F.concat_ws(",", *[F.typeof(c) for c in ("amount", "code", "day", "event_id")])
    grouped = merged.groupBy("feed_id", "subdir", kinds.alias("kinds"))
    return grouped.agg(
        F.count("*").alias("rows"), F.sum(F.col("event_id").cast("bigint")).alias("ids"), F.max("amount").alias("most"),
        F.max(F.length("code")).cast("bigint").alias("longest"), F.count_if(F.col("day") == F.col("snapshot_date")).alias("same_day"),
    )


def _write_table_files(rows: DataFrame, root: str, name: str, copies: tuple[str, ...] = ()) -> None:
    """``<root>/<feed>/<date>/<name>.txt``, one for each feed and date of ``rows``, and copies of each
    below its feed."""
    spark, staged = rows.sparkSession, f"{root}-{name}-{uuid.uuid4().hex}"
    rows.repartition(4, "feed", "subdir").write.partitionBy("feed", "subdir").option("header", True).csv(staged)
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    pattern = hadoop.Path(f"{staged}/feed=*/subdir=*/part-*.csv")
    store = pattern.getFileSystem(conf)
    for status in store.globStatus(pattern):
        feed, day = (p.partition("=")[2] for p in status.getPath().getParent().toString().rsplit("/", 2)[1:])
        for copy in copies:
            store.mkdirs(hadoop.Path(f"{root}/{feed}/{copy}").getParent())
            hadoop.FileUtil.copy(store, status.getPath(), store, hadoop.Path(f"{root}/{feed}/{copy}"), False, conf)
        store.mkdirs(hadoop.Path(f"{root}/{feed}/{day}"))
        store.rename(status.getPath(), hadoop.Path(f"{root}/{feed}/{day}/{name}.txt"))


def merge_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and customers as two tables of dated snapshots, merged by the merge job and read back.

    The tree also holds a table outside the allow-list, a folder that is no date and a snapshot after
    the range; headers differ by date."""
    root, target = scratch(spark, "tree"), scratch(spark, "merged")
    place = "CASE WHEN {c} % 2 = 0 THEN 'north' ELSE 'south' END AS feed"
    day = "CASE {c} % 3 WHEN 0 THEN '2024-10-01' WHEN 1 THEN '2024-10-02' ELSE '2024-10-05' END AS subdir"
    part, customer = star(spark, sf_dir, "part"), star(spark, sf_dir, "customer")
    routes = part.selectExpr(place.format(c="p_size"), day.format(c="p_size"), "p_partkey AS route_id", "p_name AS route_name", "'x' AS color")
    stops = customer.selectExpr(place.format(c="c_nationkey"), day.format(c="c_nationkey"), "c_custkey AS stop_id", "c_name AS stop_name")
    first = "subdir = '2024-10-01'"
    for name, rows, key, later in (("routes", routes, "route_id", ["route_name", "color", "route_id"]), ("stops", stops, "stop_id", ["stop_name", "stop_id"])):
        ignored = (f"2024-10-01/{name}-notes.txt", f"archive/{name}.txt")
        _write_table_files(rows.where(first).select("feed", "subdir", key), root, name, ignored)
        _write_table_files(rows.where(f"NOT {first}").select("feed", "subdir", *later), root, name)
    plans.merge_schedule(spark, root, target, ["routes", "stops", "trips"], ["north", "south", "west"], "2024-10-01", "2024-10-04")
    parts = []
    for kind, key, text in (("routes", "route_id", "route_name"), ("stops", "stop_id", "stop_name")):
        table = read_table(spark, target, kind)
        order = ",".join(c for c in table.columns if c not in ("feed_id", "snapshot_date"))
        grouped = table.groupBy(F.lit(kind).alias("kind"), "feed_id", "subdir", "snapshot_date").agg(
            F.count("*").alias("rows"),
            F.sum(F.col(key).cast("bigint")).alias("ids"),
            F.sum(F.length(text)).alias("sizes"),
        )
        parts.append(grouped.withColumn("columns", F.lit(order)))
    return parts[0].unionByName(parts[1])


def bus_routes_per_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.routes_per_feed(frames.routes(spark, sf_dir))


def disconnected_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.disconnected_stops(frames.stops(spark, sf_dir))


def disconnected_stops_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.disconnected_stops(frames.stops(spark, sf_dir), shared="exclude")


def _train(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        frames.train_routes(spark, sf_dir),
        frames.train_trips(spark, sf_dir),
        frames.train_stop_times(spark, sf_dir),
    )


def waiting_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.waiting_time(*_train(spark, sf_dir), dash=True)


def waiting_time_by_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.waiting_time(*_train(spark, sf_dir), by_snapshot=True)


def departure_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.departure_intervals(*_train(spark, sf_dir))


def average_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.average_trips(frames.frequencies(spark, sf_dir))


def average_trips_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.average_trips_wide(frames.frequencies(spark, sf_dir), "half_up", fill=0)


def service_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.service_quality(frames.frequencies(spark, sf_dir))


def service_quality_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts from files in which some lines end early and some go on; short lines are a reason of their own.

    The row of counts is saved and read back."""
    target = scratch(spark, "frequencies")
    rows = frames.frequencies(spark, sf_dir)
    names = ["feed_id", "subdir", "trip_id", "headway_secs", "start_time", "end_time"]
    text = [F.coalesce(F.col(c), F.lit("")) for c in names]
    cut = F.substring(F.col("trip_id"), -1, 1)
    line = F.when(cut == "7", F.concat_ws(",", *text[:-1])).when(cut == "8", F.concat_ws(",", *text, F.lit("more"))).otherwise(F.concat_ws(",", *text))
    _write_lines(rows.select(line.alias(",".join(names))), target)
    counts = plans.service_quality(read_csv_table(spark, target, faults="row_fault"))
    report = scratch(spark, "quality")
    counts.write.parquet(report)
    return spark.read.schema(counts.schema).parquet(report)


def service_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that the tasks hand over with the files they write."""
    return plans.save_service(frames.frequencies(spark, sf_dir), scratch(spark, "service")).counts


def service_saved_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected windows read back from their files, written twice to one path."""
    target = scratch(spark, "service")
    frequencies = frames.frequencies(spark, sf_dir)
    plans.save_service(frequencies, target)
    saved = plans.save_service(frequencies, target)
    both = saved.accepted.withColumn("reject_reason", F.lit("accepted")).unionByName(saved.rejected)
    return both.groupBy("operator_name", "reject_reason").agg(F.count("*").alias("rows"), F.sum("num_trips").alias("trips"))


def rejected_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = plans.rejected_service(frames.frequencies(spark, sf_dir))
    return rejected.groupBy("operator_name", "reject_reason").agg(F.count("*").alias("rows"))


def split_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected rows by reason, in one scan."""
    orders = star(spark, sf_dir, "orders").select("o_orderstatus", "o_totalprice")
    rules = {"cheap": F.col("o_totalprice") < 20000, "open": F.col("o_orderstatus") == "O"}
    reason = F.coalesce("reject_reason", F.lit("accepted")).alias("reject_reason")
    return tag_rejects(orders, rules).groupBy("o_orderstatus", reason).agg(F.count("*").alias("orders"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "distinct_per_group": distinct_names,
    "isolated_owner": isolated_owner,
    "isolated_exclusive": isolated_exclusive,
    "isolated_each": isolated_each,
    "window_unique": window_unique,
    "dedup_group_values": dedup_group_values,
    "first_per_key": first_per_key,
    "latest_per_key": latest_per_key,
    "lag_per_group": lag_previous,
    "lag_per_group_cut": lag_previous_cut,
    "lag_per_group_sampled": lag_previous_sampled,
    "headway_stats": headways,
    "prefix_relabel": prefix_relabel,
    "relabel_by_table": relabel_by_table,
    "clock_to_seconds": clock_to_seconds,
    "reject_counts": reject_counts,
    "split_rejects": split_orders,
    "daily_sum": daily_totals,
    "avg_by_day_type": day_type_mean,
    "avg_by_day_type_rounded": day_type_mean_rounded,
    "day_type_pivot": day_type_pivot,
    "merge_snapshots": merge_snapshots,
    "merge_feeds": stacked_feeds,
    "merge_tables": merge_tables,
    "merge_inferred": merge_inferred,
    "csv_scan_inferred": csv_scan_inferred,
    "csv_short_rows": csv_short_rows,
    "csv_field_guard": csv_field_guard,
    "csv_one_file": csv_one_file,
    "table_if_database": table_if_database,
    "publish_report": publish_report,
    "bus_routes_per_feed": bus_routes_per_feed,
    "disconnected_stops": disconnected_stops,
    "disconnected_stops_exclusive": disconnected_stops_exclusive,
    "waiting_time": waiting_time,
    "waiting_time_by_snapshot": waiting_time_by_snapshot,
    "departure_intervals": departure_intervals,
    "average_trips": average_trips,
    "average_trips_wide": average_trips_wide,
    "service_quality": service_quality,
    "service_quality_of_files": service_quality_of_files,
    "service_committed": service_committed,
    "service_saved_rows": service_saved_rows,
    "rejected_service": rejected_service,
}
