"""Archives written and read back, and archives made by hand."""

import base64
import gzip
import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.compare import differences
from stoploom.llm import warc
from stoploom.llm.oracle import ORACLE
from stoploom.llm.queries import QUERIES

PAGES = "page_id long, url string, html string"


def sample(seed=1):
    rng = random.Random(seed)
    bodies = [None, "", "WARC/1.1\r\nWARC-Type: response\r\n\r\n", "é" * 9, "\r\n\r\n", "x" * 300_000] + ["".join(rng.choices("ab<>\r\n é", k=rng.randint(0, 4000))) for _ in range(40)]
    rows = [(i * 3 - 7, rng.choice([f"http://h{i}.example/", None, "http://x/\r\ny\x00z"]), rng.choice(bodies)) for i in range(120)]
    rng.shuffle(rows)
    return rows


def plain(rows):
    best = {}
    for page, _, html in rows:
        best[html or ""] = max(best.get(html or "", page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = best[html or ""]
        out.append((page, len(data), digest, "response" if page == first else "revisit", None if page == first else first))
    return sorted(out)


def test_round_trip(spark, tables):
    rows = sample()
    df = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("x")).withColumn("payload", F.lit(1))
    assert sorted(tuple(r) for r in QUERIES["op3_warc"](spark, tables(pages=df.repartition(4))).collect()) == plain(rows)


def test_sql_agrees(spark, tmp_path):
    spark.createDataFrame(sample(2), PAGES).toPandas().to_parquet(tmp_path / "pages.parquet")
    assert differences(QUERIES["op3_warc"](spark, str(tmp_path)), str(tmp_path), ORACLE["op3_warc"]) is None


@pytest.mark.parametrize("compressed", ["true", "false"])
def test_payloads_headers_and_small_files(spark, tmp_path, compressed):
    rows = sample(3)
    records = warc.with_revisits(spark.createDataFrame(rows, PAGES))
    warc.write_warc(records, str(tmp_path / "a"), compressed=compressed, fileBytes="3000")
    assert len(list((tmp_path / "a").glob("*.warc*"))) > 5
    read = warc.read_warc(spark, str(tmp_path / "a")).collect()
    want = {f"<urn:x-page:{p}>": (u, (h or "").encode()) for p, u, h in rows}
    assert len(read) == len(rows)
    for r in read:
        url, body = want[r["record_id"]]
        assert r["payload"] == (body if r["record_type"] == "response" else b"")
        assert r["payload_length"] == len(body)
        assert r["target_uri"] == (url and url.replace("\r", "%0D").replace("\n", "%0A").replace("\x00", "%00"))


@pytest.mark.parametrize(
    "where",
    [
        "record_type = 'revisit'",
        "record_type in ('response', 'other')",
        "payload_length > 1000 and target_uri like 'http://h1%'",
        "target_uri is null",
        "target_uri is not null and not record_type = 'response'",
        "refers_to <=> null",
        "target_uri like '%1.example/' or payload_length < 5",
        "not (target_uri like '%9.example/')",
        "target_uri not in ('http://h1.example/') and payload_length between 0 and 50",
        "payload_digest >= 'M'",
    ],
)
def test_predicates_keep_their_meaning(spark, tmp_path, where):
    path = str(tmp_path / "a")
    warc.write_warc(warc.with_revisits(spark.createDataFrame(sample(4), PAGES)), path)
    columns = warc.SCHEMA.replace(", payload binary", "")
    whole = warc.read_warc(spark, path, columns).collect()
    held = spark.createDataFrame(whole, columns).where(where).collect()
    assert sorted(map(str, warc.read_warc(spark, path, columns).where(where).collect())) == sorted(map(str, held))


def test_type_and_header_predicates_are_pushed(spark, tmp_path):
    path = str(tmp_path / "a")
    warc.write_warc(warc.with_revisits(spark.createDataFrame(sample(4), PAGES)), path)
    df = warc.read_warc(spark, path).where("record_type = 'response' and target_uri like 'http://h%' and payload_length > 3")
    assert "Filter" not in df._jdf.queryExecution().executedPlan().toString().replace("RuntimeFilters", "")


def test_unwanted_payloads_are_not_read(tmp_path):
    """Neither decoded nor, with skip lengths, inflated."""
    big = "z".join(map(str, range(200_000)))
    record = warc.record_bytes({"record_type": "response", "record_id": "<a:1>", "payload": big.encode()})
    last = warc.record_bytes({"record_type": "revisit", "record_id": "<a:2>", "payload": b"q"})

    class Counting:
        def __init__(self, data):
            self.data, self.at, self.read_bytes = data, 0, 0

        def size(self):
            return len(self.data)

        def seek(self, at):
            self.at = at

        def read(self, n):
            out = self.data[self.at : self.at + n]
            self.at, self.read_bytes = self.at + len(out), self.read_bytes + len(out)
            return out

    for records, data in ((warc.plain_records, record + last), (warc.zipped_records, warc.zipped(record) + warc.zipped(last))):
        file = Counting(data)
        found = list(records(file, lambda row: True if row["record_type"] == "revisit" else None))
        assert [(r["record_id"], p) for r, p in found] == [("<a:2>", b"")]
        assert file.read_bytes < 4 * 4096
        assert [len(p) for _, p in records(Counting(data), lambda row: True)] == [len(big), 0]


def test_archives_from_elsewhere(spark, tmp_path):
    """No manifest, no skip lengths, other headers and kinds of records."""
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Type: application/warc-fields\r\nContent-Length: 9\r\n\r\nkey: val\n\r\n\r\n"
    page = b"HTTP/1.0 200 OK\r\nServer: s\r\n\r\nbody \xff\x00"
    response = b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID:<urn:uuid:2>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(page), page)
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(response))
    (tmp_path / "b.warc").write_bytes(response + info)
    (tmp_path / "notes.txt").write_bytes(b"no archive")
    got = sorted((r["record_type"], r["record_id"], bytes(r["payload"])) for r in warc.read_warc(spark, str(tmp_path)).collect())
    assert got == [("response", "<urn:uuid:2>", b"body \xff\x00")] * 2 + [("warcinfo", "<urn:uuid:1>", b"key: val\n")] * 2


def test_files_of_lost_attempts_are_not_read_and_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "a")
    first = warc.with_revisits(spark.createDataFrame([(1, "u", "one")], PAGES))
    warc.write_warc(first, path)
    stray = next(Path(path).glob("*.warc.gz"))
    (tmp_path / "a" / "stray.warc.gz").write_bytes(stray.read_bytes())
    warc.write_warc(warc.with_revisits(spark.createDataFrame([(2, "u", "two")], PAGES)), path)
    assert sorted(r["record_id"] for r in warc.read_warc(spark, path).collect()) == ["<urn:x-page:1>", "<urn:x-page:2>"]
    warc.write_warc(first, path, mode="overwrite")
    assert [r["record_id"] for r in warc.read_warc(spark, path).collect()] == ["<urn:x-page:1>"]


def test_null_ids_repeated_rows_and_empty_table(spark, tmp_path):
    rows = [(None, None, None), (3, "u", "same"), (3, "u", "same"), (2, "v", "same"), (None, "w", "same")]
    got = warc.round_trip(spark.createDataFrame(rows, PAGES), str(tmp_path / "a")).collect()
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got) == sorted(
        [("None", 0, "response", None), ("3", 4, "response", None), ("3", 4, "response", None), ("2", 4, "revisit", 3), ("None", 4, "revisit", 3)], key=str
    )
    assert warc.round_trip(spark.createDataFrame([], PAGES), str(tmp_path / "b")).collect() == []
