import os

import pytest
from pyspark.sql import functions as F

from stoploom.functions import field_count
from stoploom.operators import common_types, with_types
from stoploom.plans import merge_schedule
from stoploom.sinks import publish, save_table_if_db, write_csv, write_partitioned, writers
from stoploom.sources import (
    column_names,
    discover,
    manifest,
    merge_all,
    merge_snapshots,
    read_csv_table,
    read_table,
    snapshots,
)

TREE = {
    # first and last day of the range, and the days around it
    "rail/2024-09-30/stops.txt": "stop_id,stop_name\nearly,x\n",
    "rail/2024-10-01/stops.txt": 'stop_id,stop_name\n1,"A, upper"\n2,\n',
    "rail/2025-05-31/stops.txt": "stop_name,stop_id\nB,3\n",
    "rail/2025-06-01/stops.txt": "stop_id,stop_name\nlate,x\n",
    # extra column, byte-order mark, blanks and capitals in the header
    "rail/2024-10-02/stops.txt": "﻿Stop_ID, stop_name ,zone\n4,C,z1\n5,D\n",
    # header only: no rows, but its column counts
    "rail/2024-10-03/stops.txt": "stop_id,wheelchair\n",
    "rail/2024-10-04/stops.txt": "",
    "rail/2024-10-05/stops.txt": "\n\nstop_id,stop_name\n6,E\n",
    # not a date, impossible date, lenient spelling
    "rail/latest/stops.txt": "stop_id,stop_name\nno,x\n",
    "rail/2024-13-01/stops.txt": "stop_id,stop_name\nno,x\n",
    "rail/2024-10-6/stops.txt": "stop_id,stop_name\nno,x\n",
    # not on the allow-list
    "rail/2024-10-01/shapes.txt": "shape_id\n1\n",
    "rail/2024-10-01/stops.csv": "stop_id\nno\n",
    # a date folder deeper down, a stamped name among the file's own columns
    "bus {x}+1/north/2024-10-01/stops.txt": "feed_id,stop_id,subdir\nown,7,own\n",
    "bus {x}+1/2024-10-01/trips.txt": "trip_id,route_id\nt1,r1\n",
    "ferry/2024-10-01/stops.txt": "stop_id\n8\n",
}


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "raw tree+=@,1 (é)"
    for name, text in TREE.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    return str(root)


STOPS = [
    ("bus {x}+1", "2024-10-01", "7", None, None, None),
    ("rail", "2024-10-01", "1", "A, upper", None, None),
    ("rail", "2024-10-01", "2", None, None, None),
    ("rail", "2024-10-02", "4", "C", None, "z1"),
    ("rail", "2024-10-02", "5", "D", None, None),
    ("rail", "2024-10-05", "6", "E", None, None),
    ("rail", "2025-05-31", "3", "B", None, None),
]
RANGE = {"first_day": "2024-10-01", "last_day": "2025-05-31"}
FEEDS = ["rail", "bus {x}+1", "tram"]


@pytest.mark.parametrize("block", [1, 7, 1 << 14])
def test_merge_snapshots(spark, rows, tree, monkeypatch, block):
    monkeypatch.setattr(snapshots, "HEADER_BLOCK", block)
    for root in (tree, tree + "/", "file:" + tree):
        merged = merge_snapshots(spark, root, "stops", FEEDS, **RANGE)
        assert merged.columns == [
            "feed_id",
            "subdir",
            "snapshot_date",
            "stop_id",
            "stop_name",
            "wheelchair",
            "zone",
        ]
        assert rows(merged.drop("snapshot_date")) == STOPS
        assert merged.filter("CAST(snapshot_date AS STRING) <> subdir").isEmpty()


def test_all_feeds_and_no_range(spark, tree):
    merged = merge_snapshots(spark, tree, "stops")
    assert {r[0] for r in merged.select("feed_id").collect()} == {"rail", "bus {x}+1", "ferry"}
    assert {"early", "late"} <= {r[0] for r in merged.select("stop_id").collect()}
    assert merge_snapshots(spark, tree, "agency") is None


def test_discover_lists_the_allowed_files_only(spark, tree):
    files = discover(spark, tree, ["stops", "trips"], FEEDS, **RANGE)
    assert [(f.table, f.feed, str(f.day)) for f in files] == [
        ("stops", "bus {x}+1", "2024-10-01"),
        ("stops", "rail", "2024-10-01"),
        ("stops", "rail", "2024-10-02"),
        ("stops", "rail", "2024-10-03"),
        ("stops", "rail", "2024-10-05"),
        ("stops", "rail", "2025-05-31"),
        ("trips", "bus {x}+1", "2024-10-01"),
    ]
    with pytest.raises(ValueError, match="file_glob"):
        discover(spark, tree, ["stops", "trips"], file_glob="*.txt")


def test_header_of_a_file_larger_than_a_split(spark, tmp_path, rows):
    body = "".join(f"{i},name {i}\n" for i in range(20000))
    for day, header in (("2024-10-01", "stop_id,stop_name\n"), ("2024-10-02", "stop_name,stop_id\n")):
        (tmp_path / "f" / day).mkdir(parents=True)
        (tmp_path / "f" / day / "stops.txt").write_text(header + body)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "20000")
        merged = merge_snapshots(spark, str(tmp_path), "stops")
        assert merged.rdd.getNumPartitions() > 4
        counts = merged.groupBy("subdir").agg(
            F.count("*"), F.sum(F.col("stop_id").try_cast("bigint")), F.count_if(F.col("stop_name") < "a")
        )
        total = sum(range(20000))
        assert rows(counts) == [("2024-10-01", 20000, total, 0), ("2024-10-02", 20000, None, 20000)]
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("lines", [1, 50, 40_000])
def test_file_without_header_is_not_dropped_silently(spark, tmp_path, lines):
    folder = tmp_path / "f" / "2024-10-01"
    folder.mkdir(parents=True)
    (folder / "stops.txt").write_text("\n" * lines)
    with pytest.raises(ValueError, match="no header"):
        merge_snapshots(spark, str(tmp_path), "stops")


@pytest.mark.parametrize("more", [0, 5_000])
@pytest.mark.parametrize("block", [3, 1 << 14])
def test_headers_do_not_depend_on_the_size_of_a_file(spark, rows, tmp_path, monkeypatch, more, block):
    """Tab-only, blank, BOM, CRLF and CR first lines, and a header longer than a block."""
    monkeypatch.setattr(snapshots, "HEADER_BLOCK", block)
    wide = ",".join(f"c{i:04}" for i in range(400))
    heads = ["\t\nstop_id,stop_lat\n", "\n \n\r\nstop_id,stop_lat\r\n", "\ufeffstop_id,stop_lat\n", "\rstop_id,stop_lat\r", f"stop_id,stop_lat,{wide}\n"]
    body = "".join(f"{i},{i + 0.5}\n" for i in range(2 + more))
    for k, head in enumerate(heads):
        folder = tmp_path / f"f{k}" / "2024-10-01"
        folder.mkdir(parents=True)
        (folder / "stops.txt").write_bytes((head + body).encode())
    merged = merge_snapshots(spark, str(tmp_path), "stops")
    assert len(merged.columns) == 5 + 400
    counts = merged.groupBy("feed_id").agg(F.count("*"), F.count("stop_lat"), F.max(F.col("stop_id").cast("int")))
    assert rows(counts) == [(f"f{k}", 2 + more, 2 + more, 1 + more) for k in range(len(heads))]


def test_header_step_reads_blocks_not_files(spark, tmp_path):
    """A file of a tebibyte, all of it but the header a hole: reading it whole would never end."""
    path = tmp_path / "big.txt"
    path.write_text("stop_id,stop_lat\n")
    os.truncate(path, 1 << 40)
    files = spark.createDataFrame([(f"file:{path}",), (str(path),)], "path string")
    assert {r["header"] for r in snapshots.with_headers(files).collect()} == {"stop_id,stop_lat"}


def test_plain_paths_are_not_decoded_per_row(spark, tmp_path):
    for feed in ("a", "b"):
        folder = tmp_path / feed / "date=2024-10-01"
        folder.mkdir(parents=True)
        (folder / "stops.txt").write_text(f"stop_id\n{feed}1\n")
        (folder / "more-stops.txt").write_text(f"stop_id\n{feed}2\n")
    merged = merge_snapshots(spark, str(tmp_path), "stops")
    assert "decode" not in merged._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.feed_id + r.stop_id for r in merged.collect()) == ["aa1", "bb1"]
    both = merge_snapshots(spark, str(tmp_path), "stops", file_glob="*.txt")
    assert sorted(r.feed_id + r.stop_id for r in both.collect()) == ["aa1", "aa2", "bb1", "bb2"]
    assert {r.subdir for r in both.collect()} == {"2024-10-01"}


def test_only_the_files_of_a_chosen_day_are_read(spark, tree):
    merged = merge_snapshots(spark, tree, "stops", FEEDS, **RANGE)
    one_day = merged.filter("snapshot_date = DATE'2024-10-01'").select("stop_id")
    assert one_day.rdd.getNumPartitions() <= merged.rdd.getNumPartitions()
    assert one_day.count() == 3


def test_merge_all_skips_tables_without_data(spark, tree):
    merged = merge_all(spark, tree, ["agency", "stops", "trips"], FEEDS, **RANGE)
    assert list(merged) == ["stops", "trips"]


def test_column_names():
    assert column_names('﻿A, b ,"c,d",,b') == ("a", "b", "c,d", "_c3", "b4")


def test_merge_job_to_parquet_and_csv(spark, rows, tree, tmp_path):
    parquet, text = str(tmp_path / "parquet"), str(tmp_path / "csv")
    arguments = {"tables": ["agency", "stops", "trips"], "feeds": FEEDS, **RANGE}
    assert merge_schedule(spark, tree, parquet, **arguments) == ["stops", "trips"]
    assert merge_schedule(spark, tree, text, fmt="csv", **arguments) == ["stops", "trips"]
    columns = ["feed_id", "subdir", "stop_id", "stop_name", "wheelchair", "zone"]
    stored = read_table(spark, parquet, "stops")
    assert rows(stored.select(*columns)) == STOPS
    assert rows(read_table(spark, text, "stops", "csv")) == STOPS
    plan = stored.filter("feed_id = 'rail'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(feed_id" in plan
    # a second run replaces the first
    merge_schedule(spark, tree, parquet, **arguments)
    assert read_table(spark, parquet, "stops").count() == len(STOPS)
    with pytest.raises(ValueError, match="fmt"):
        merge_schedule(spark, tree, text, fmt="orc", **arguments)


def test_partitions_without_new_rows_can_stay(spark, rows, tmp_path):
    target = str(tmp_path / "t")
    first = spark.createDataFrame([("a", "1", 1), ("b", "1", 2)], "feed_id string, d string, n int")
    write_partitioned(first, target, ["feed_id", "d"])
    write_partitioned(
        spark.createDataFrame([("b", "1", 3)], "feed_id string, d string, n int"),
        target,
        ["feed_id", "d"],
        only_touched=True,
    )
    assert rows(spark.read.parquet(target).select("feed_id", "n")) == [("a", 1), ("b", 3)]


def test_feed_names_stay_text(spark, rows, tmp_path):
    stops = spark.createDataFrame(
        [("001", "2024-10-01", "a"), ("2", "2024-10-01", "b")],
        "feed_id string, snapshot_date string, stop_id string",
    )
    write_partitioned(stops, str(tmp_path / "stops"))
    stored = read_table(spark, str(tmp_path), "stops")
    assert rows(stored.select("feed_id", "stop_id")) == [("001", "a"), ("2", "b")]
    assert dict(stored.dtypes)["snapshot_date"] == "date"


def test_csv_reading(spark, rows, tmp_path):
    folder = tmp_path / "stops"
    folder.mkdir()
    (folder / "a.csv").write_text('id;name;n\n1;" x;y ";2\n2;  ;\n3\n')
    (folder / "b.csv").write_text("id;name;n\n4;z;5\n")
    (folder / "c.txt").write_text("other\n")
    pattern = f"{folder}/*.csv"
    assert {kind for _, kind in read_csv_table(spark, pattern, sep=";").dtypes} == {"string"}
    assert read_csv_table(spark, pattern, sep=";", infer=True).dtypes == [
        ("id", "int"),
        ("name", "string"),
        ("n", "int"),
    ]
    trimmed = read_csv_table(spark, [str(folder / "a.csv"), str(folder / "b.csv")], ";", trim=True)
    assert [r[1] for r in rows(trimmed)] == ["x;y", None, None, "z"]


def test_csv_writing(spark, tmp_path):
    df = spark.range(100).repartition(4)
    one, many = (str(tmp_path / n) for n in ("one", "many"))
    write_csv(df, one, one_file=True)
    write_csv(df, many)
    files = {p: len(list((tmp_path / p).glob("part-*.csv"))) for p in ("one", "many")}
    assert files == {"one": 1, "many": 4}
    for path in (one, many):
        assert read_csv_table(spark, path).count() == 100


def test_reports_are_published_whole(spark, tmp_path, capsys):
    df = spark.range(50).selectExpr("concat('a', id) AS feed_id", "nullif(id, 3) AS n")
    assert not save_table_if_db(df, "no_such_db", "t")
    with pytest.raises(ValueError, match="no_such_db"):
        publish(df, "t", "no_such_db")
    assert capsys.readouterr().out == ""
    publish(df, "t")
    printed = capsys.readouterr().out.splitlines()
    assert printed[0] == "feed_id\tn" and len(printed) == 51 and "a3\t" in printed
    publish(df, "t", "no_such_db", str(tmp_path / "out"))
    assert read_csv_table(spark, str(tmp_path / "out")).count() == 50
    spark.sql(f"CREATE DATABASE loom_test LOCATION '{tmp_path / 'db'}'")
    try:
        publish(df, "t", "loom_test")
        assert publish(df.unionByName(df), "t", "loom_test").count() == 100
        assert spark.table("loom_test.t").count() == 100
        assert capsys.readouterr().out == ""
    finally:
        spark.sql("DROP DATABASE loom_test CASCADE")


def _many_files(root, days=40, feeds=("north west", "south")):
    """Three headers that change over time."""
    heads = ["stop_id,stop_name", "stop_name,stop_id", "zone,stop_id,stop_name"]
    for f, feed in enumerate(feeds):
        for d in range(days):
            folder = root / feed / f"2024-{10 + d // 28}-{d % 28 + 1:02}"
            folder.mkdir(parents=True)
            names = heads[(d // 9 + f) % 3].split(",")
            value = {"stop_id": str(d), "stop_name": f"{feed} {d}", "zone": "z"}
            (folder / "stops.txt").write_text(",".join(names) + "\n" + ",".join(value[n] for n in names) + "\n")


def test_no_list_of_files_in_the_plan(spark, rows, tmp_path):
    _many_files(tmp_path)
    merged = merge_snapshots(spark, str(tmp_path), "stops")
    plan = merged._jdf.queryExecution().toString()
    assert "stops.txt" not in plan.replace("{stops.txt}", "") and plan.count("2024-") < 30
    assert plan.split("== Physical Plan ==")[1].count("FileScan csv") == 1
    found = rows(merged.selectExpr("feed_id", "CAST(stop_id AS INT) AS d", "stop_name", "zone IS NULL AS none").filter("none"))
    want = [(f, d, f"{f} {d}", True) for k, f in enumerate(("north west", "south")) for d in range(40) if (d // 9 + k) % 3 < 2]
    assert found == sorted(want, key=lambda r: [(True, str(v)) for v in r])
    assert merged.count() == 80


def test_the_manifest_is_a_table(spark, rows, tree, tmp_path):
    files = manifest(spark, tree, ["stops", "trips"], FEEDS, **RANGE)
    assert rows(files.select("table", "feed").distinct()) == [("stops", "bus {x}+1"), ("stops", "rail"), ("trips", "bus {x}+1")]
    kept = str(tmp_path / "kept")
    merged = merge_snapshots(spark, tree, "stops", FEEDS, **RANGE, store=kept)
    assert rows(merged.drop("snapshot_date")) == STOPS
    assert spark.read.parquet(kept).count() == 6


def test_files_of_other_days_and_feeds_are_not_opened(spark, tmp_path):
    """Those would never be read to their end."""
    for feed, day in (("a", "2024-10-01"), ("a", "2024-12-01"), ("b", "2024-10-01")):
        folder = tmp_path / feed / day
        folder.mkdir(parents=True)
        (folder / "stops.txt").write_text("stop_id\n1\n")
        if (feed, day) != ("a", "2024-10-01"):
            os.truncate(folder / "stops.txt", 1 << 40)
    merged = merge_snapshots(spark, str(tmp_path), "stops", ["a"], "2024-10-01", "2024-10-31")
    assert [tuple(r) for r in merged.select("feed_id", "stop_id").collect()] == [("a", "1")]


def test_short_and_long_rows_of_every_header(spark, rows, tree):
    merged = merge_snapshots(spark, tree, "stops", FEEDS, **RANGE, faults="fault")
    assert rows(merged.select("stop_id", "fault").filter("fault IS NOT NULL")) == [("5", "short_row")]
    assert rows(merged.drop("snapshot_date", "fault")) == STOPS


def test_one_type_for_all_headers(spark, rows, tmp_path):
    for k, text in enumerate(["id,n,when,flag,name\n1,2,2024-10-01,true,a\n", "n,id,name\n2.5,30000000000,7\n", "flag,when,id,none\nfalse,2024-10-02 10:30:00,3,\n"]):
        folder = tmp_path / "f" / f"2024-10-0{k + 1}"
        folder.mkdir(parents=True)
        (folder / "stops.txt").write_text(text)
    merged = merge_snapshots(spark, str(tmp_path), "stops", infer=True)
    assert dict(merged.dtypes[3:]) == {"id": "bigint", "n": "double", "when": "timestamp_ntz", "flag": "boolean", "name": "string", "none": "string"}
    assert rows(merged.select("id", "n", "name")) == [(1, 2.0, "a"), (3, None, None), (30000000000, 2.5, "7")]


def test_common_types(spark):
    values = {"int": ["1", " -2 ", None], "bigint": ["1", "3000000000"], "double": ["1", ".5", "1e3"], "string": ["1", "x"], "date": ["2024-02-29"], "boolean": ["TRUE", "false"]}
    frames = {k: spark.createDataFrame([(v,) for v in vs], "v string") for k, vs in values.items()}
    assert {k: common_types(df, ["v"])["v"] for k, df in frames.items()} == {k: k for k in values}
    for odd in ("1d", "NaN", "2024-02-30", "1,5", ""):
        assert common_types(spark.createDataFrame([(odd,)], "v string"), ["v"]) == {"v": "string"}
    empty = spark.createDataFrame([(None,)], "v string")
    assert with_types(empty, ["v"]).dtypes == [("v", "string")] and common_types(empty, []) == {}


def test_field_counts(spark):
    lines = {"a": 1, "": 1, "a,b": 2, ",,": 3, '"a,b",c': 2, 'a,"x ""y, z"",",': 3, r'"a\", b",c': 2, 'in "a, b" out': 2}
    df = spark.createDataFrame(list(lines.items()), "line string, n int")
    assert [(r["line"], r["found"]) for r in df.select("line", field_count("line").alias("found"), "n").collect() if r["found"] != lines[r["line"]]] == []
    assert spark.sql("SELECT CAST(NULL AS STRING) AS line").select(field_count("line")).first()[0] is None


def test_short_and_long_lines(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text('a;b;c\n1;2;3\n1;2\n1\n1;2;3;4\n"x;y";2;3\n1;;\n')
    table = read_csv_table(spark, str(tmp_path), sep=";", faults="fault", infer=True)
    assert table.dtypes == [("a", "string"), ("b", "int"), ("c", "int"), ("fault", "string")]
    assert [r["fault"] for r in table.collect()] == [None, "short_row", "short_row", "long_row", None, None]
    assert table.select("fault").filter("fault IS NOT NULL").count() == 3


def test_one_file_is_joined_from_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "_COPIED", 7)
    df = spark.range(500, numPartitions=6).selectExpr("id", "concat('x, \"', id, '\"') AS `a,b`", "nullif(id, 3) AS n").sort("id")
    target = tmp_path / "one"
    write_csv(df, str(target), one_file=True)
    write_csv(df, str(target), one_file=True)
    assert sorted(p.name for p in target.iterdir() if p.suffix != ".crc") == ["_SUCCESS", "part-00000.csv"]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["one"]
    back = read_csv_table(spark, str(target), infer=True)
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in df.collect()] and back.columns == df.columns
    with pytest.raises(Exception, match="no row"):
        write_csv(df.withColumn("id", F.raise_error(F.lit("no row")).cast("long")), str(target), one_file=True)
    assert read_csv_table(spark, str(target)).count() == 500 and len(list(tmp_path.iterdir())) == 1
    write_csv(df.limit(0), str(target), one_file=True)
    assert (target / "part-00000.csv").read_text() == 'id,"a,b",n\n'


def test_a_failed_write_keeps_the_old_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE loom_swap LOCATION '{tmp_path / 'db'}'")
    try:
        assert save_table_if_db(spark.range(5), "loom_swap", "t")
        broken = spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")))
        with pytest.raises(Exception, match="broken"):
            save_table_if_db(broken, "loom_swap", "t")
        assert spark.table("loom_swap.t").count() == 5
        save_table_if_db(spark.table("loom_swap.t").limit(3), "loom_swap", "t")  # from its own rows
        assert spark.table("loom_swap.t").count() == 3
        assert [t.name for t in spark.catalog.listTables("loom_swap")] == ["t"]
    finally:
        spark.sql("DROP DATABASE loom_swap CASCADE")


def test_console_shows_first_rows_and_counts_all(spark, capsys, tmp_path):
    writers.print_rows(spark.range(30), most=4)
    assert capsys.readouterr().out.splitlines() == ["id", "0", "1", "2", "3", "(4 of 30 rows; name a database or an output path for all of them)"]
    publish(spark.range(30, numPartitions=3), "t", path=str(tmp_path / "many"), one_file=False)
    assert len(list((tmp_path / "many").glob("part-*.csv"))) == 3
