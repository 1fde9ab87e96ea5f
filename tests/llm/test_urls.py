"""Verdicts against a plain look-up of every entry for every capture."""

import datetime as dt
import random

from pyspark.sql import functions as F

from checks.compare import differences
from stoploom.llm import urls
from stoploom.llm.oracle import ORACLE
from stoploom.llm.queries import QUERIES

ENTRIES = "list string, blocks boolean, kind string, pattern string, day date, listed boolean"
BASE = dt.date(2024, 1, 1)


def day(n):
    return BASE + dt.timedelta(days=n)


def active(entries, when):
    """(list, kind, pattern, blocks) that hold on a day."""
    last = {}
    for name, blocks, kind, pattern, at, listed in entries:
        if None in (name, kind, pattern, at, listed) or when is None or at > when:
            continue
        key = name, kind, pattern
        if key not in last or at > last[key][0]:
            last[key] = at, listed, blocks
        elif at == last[key][0]:
            last[key] = at, last[key][1] and listed, last[key][2] and blocks
    return [(*k, blocks) for k, (_, listed, blocks) in last.items() if listed]


def matches(kind, pattern, url):
    scheme, mark, rest = (url or "").partition("://")
    if not mark or not scheme.isascii() or not scheme.replace("+", "a").isalnum():
        return False
    place = rest
    for c in "/?#":
        place = place.split(c)[0]
    host = place.split("@")[-1].rsplit(":", 1)[0].lower().removesuffix(".")
    if not host:
        return False
    path = [s for s in rest[len(place) :].split("?")[0].split("#")[0].split("/") if s]
    if kind == "domain":
        return host == pattern or host.endswith("." + pattern)
    if kind == "url":
        return url.split("#")[0] == pattern
    whole = [host, *path]
    want = pattern.split("/")
    return whole[: len(want)] == want


def test_verdicts_equal_a_plain_look_up(spark):
    rng = random.Random(4)
    hosts = ["a.example.com", "www.a.example.com", "b.example.com", "example.com", "c.org", "deep.x.y.c.org"]
    found = [f"http://{h}/{p}" for h in hosts for p in ("", "en", "en/1", "en/1.html?q=1", "/en//2/#top")]
    found += ["HTTPS://User:pw@A.Example.COM:8080/en/1", "http://c.org.", "http://", "no url", "", None, "ftp://c.org/en"]
    captures = [(i, rng.choice(found), rng.choice([None, *map(day, range(0, 60, 3))])) for i in range(600)]
    captures += captures[:5] + [(1000 + i, "http://a.example.com/en", day(30)) for i in range(300)]
    patterns = [("domain", p) for p in (*hosts, "com", "org", "y.c.org", "ample.com")] + [("path", p) for p in ("a.example.com", "a.example.com/en", "c.org/en", "example.com/en/1")]
    patterns += [("url", "http://c.org/en/1.html?q=1"), ("url", "http://example.com/en"), ("url", None), ("domain", "")]
    entries = [(rng.choice(["x", "y", "good"]), None, *rng.choice(patterns), day(rng.randint(0, 60)), rng.random() < 0.6) for _ in range(120)]
    entries = [(n, n != "good", *rest) for n, _, *rest in entries] + [(None, True, "domain", "com", day(1), True), ("x", True, "domain", "com", None, True)]
    frame = spark.createDataFrame(captures, "page_id long, url string, day date").withColumn("kind", F.lit("k")).withColumn("n", F.lit(1))
    got = urls.judge(frame, urls.validity(spark.createDataFrame(entries, ENTRIES)))
    assert got.columns[:5] == ["page_id", "url", "day", "kind", "n"]
    want = []
    for page, url, when in captures:
        hits = [e for e in active(entries, when) if matches(e[1], e[2], url)]
        least = min((f"{n}|{k}|{p}" for n, k, p, _ in hits), default=None)
        want.append((page, url, when, bool(hits) and all(b for *_, b in hits), len(hits), ",".join(sorted({h[0] for h in hits})), least))
    assert sorted(map(str, (tuple(r[:3] + r[5:]) for r in got.collect()))) == sorted(map(str, want))


def test_intervals_of_repeated_and_contradicting_entries(spark):
    rows = [("l", True, "domain", "a", day(d), on) for d, on in ((5, True), (7, True), (9, False), (9, True), (12, False), (15, True), (15, True), (20, False))]
    got = sorted((r["valid_from"], r["valid_to"]) for r in urls.validity(spark.createDataFrame(rows, ENTRIES)).collect())
    assert got == [(day(5), day(9)), (day(15), day(20))]


def test_sql_agrees(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, "x", f"https://{rng.choice('abc')}{i % 30}.ex{i % 4}.com/{rng.choice(['en', 'de', ''])}/{i}#t"]), "") for i in range(400)]
    spark.createDataFrame(rows, "page_id long, url string, html string").toPandas().to_parquet(tmp_path / "pages.parquet")
    assert differences(QUERIES["op5_url_filters"](spark, str(tmp_path)), str(tmp_path), ORACLE["op5_url_filters"]) is None


def test_built_ins_only_and_empty_tables(spark):
    captures, entries = spark.createDataFrame([], "url string, day date"), spark.createDataFrame([], ENTRIES)
    out = urls.judge(captures, urls.validity(entries))
    assert out.collect() == [] and "Python" not in out._jdf.queryExecution().toString()
    some = urls.judge(spark.createDataFrame([("http://a/", day(1))], "url string, day date"), urls.validity(entries))
    assert [r["blocked"] for r in some.collect()] == [False]
