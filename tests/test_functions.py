import datetime

import pytest
from pyspark.sql import functions as F

from stoploom.functions import (
    as_double,
    clock_seconds,
    dashed,
    day_type,
    epoch_seconds,
    grid_cell,
    iso_weekday,
    key_text,
    prefix,
    snapshot_day,
    trim_all,
    trimmed,
    truncated_ratio,
)


def apply(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column).head()[0]


@pytest.mark.parametrize(
    ("text", "seconds"),
    [
        ("00:00:00", 0),
        ("05:10:30", 18630),
        ("5:10:00", 18600),
        ("24:10:00", 87000),
        ("100:00:01", 360001),
        (" 9:00:00 ", 32400),
        ("9:5:7", 32707),
        ("", None),
        ("  ", None),
        (None, None),
        ("9:00", None),
        ("9:00:00:00", None),
        ("9:60:00", None),
        ("9:00:60", None),
        ("-1:00:00", None),
        ("-0:30:00", None),
        ("+7:00:00", None),
        ("7: 05:00", None),
        ("7:005:00", None),
        ("a:00:00", None),
        ("9:00:00.5", None),
        ("2147483647:00:00", 2147483647 * 3600),
        ("99999999999:00:00", None),
    ],
)
def test_clock_seconds(spark, text, seconds):
    assert apply(spark, clock_seconds("v"), text) == seconds


def test_epoch_seconds_ignores_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'1970-01-02 00:00:01.9' AS v")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Asia/Kuala_Lumpur"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert df.select(epoch_seconds("v")).head()[0] == 86401
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2024-10-01", datetime.date(2024, 10, 1)),
        (" 2024-10-01 ", datetime.date(2024, 10, 1)),
        ("2024-1-5", None),
        ("2024-02-30", None),
        ("2024-10-01T00", None),
        ("latest", None),
        ("", None),
        (None, None),
    ],
)
def test_snapshot_day(spark, text, day):
    assert apply(spark, snapshot_day("v"), text) == day


def test_weekday_and_day_type(spark):
    # Friday, Saturday, Sunday, Monday
    days = [datetime.date(2024, 10, d) for d in (4, 5, 6, 7)]
    df = spark.createDataFrame([(d,) for d in days] + [(None,)], "v date")
    found = [tuple(r) for r in df.select(iso_weekday("v"), day_type("v")).collect()]
    assert found == [(5, "weekday"), (6, "weekend"), (7, "weekend"), (1, "weekday"), (None, None)]


def test_text_helpers(spark):
    assert apply(spark, trimmed("v"), "  a ") == "a"
    assert apply(spark, trimmed("v"), "   ") is None
    assert apply(spark, prefix("v", 3), "AGL_1") == "AGL"
    assert apply(spark, prefix("v", 3), "AB") == "AB"
    assert apply(spark, dashed("v"), "KL Sentral A") == "KL-Sentral-A"
    assert apply(spark, key_text("v", F.lit(None).cast("string"), F.lit(1)), "R") == "R__1"
    df = spark.createDataFrame([(" x ", 1, "")], "`a.b` string, n int, c string")
    assert tuple(trim_all(df).head()) == ("x", 1, None)


def test_numbers(spark):
    assert apply(spark, as_double("v"), " 3.10") == 3.1
    assert apply(spark, as_double("v"), "abc") is None
    assert apply(spark, grid_cell("v", 2), 2.675, "double") == 2.68
    assert apply(spark, truncated_ratio("v", F.lit(700)), 3600, "int") == 5
    assert apply(spark, truncated_ratio("v", F.lit(700)), -3600, "int") == -5
    assert apply(spark, truncated_ratio("v", F.lit(0)), 3600, "int") is None
    assert apply(spark, truncated_ratio("v", F.lit(1e-300)), 3600, "int") is None
    assert apply(spark, truncated_ratio("v", F.lit(float("nan"))), 3600, "int") is None
