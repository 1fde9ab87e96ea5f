"""Fingerprints against a plain one-permutation MinHash."""

import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from stoploom.llm import fingerprints as fp
from stoploom.llm.queries import QUERIES

QUERY = QUERIES["op2_document_fingerprints"]


def chain(parts):
    """Spark's xxhash64 of several values: each seeds the next."""
    h = 42
    for p in parts:
        data = p if isinstance(p, bytes) else int(p).to_bytes(4, "little", signed=True)
        h = xxhash.xxh64_intdigest(data, h)
    return h


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def plain_fingerprint(text):
    bins = {}
    for s in shingles(text):
        h = signed(chain([w.encode() for w in s]))
        bins[h >> 56] = min(h, bins.get(h >> 56, h))
    row = [bins.get(b) for b in range(-128, 128)]
    out = ""
    for k, h in enumerate(row):
        if h is None:
            tried = (row[signed(chain([k, t])) % 256] for t in range(1, 25))
            h = next((x for x in tried if x is not None), None)
            if h is None:
                h = row[min((signed(chain([k, j, 0])), j) for j in range(256) if row[j] is not None)[1]]
        out += "0123456789abcdef"[h & 15]
    return out


def plain_likeness(a, b):
    return max(0.0, (sum(x == y for x, y in zip(a, b, strict=True)) / 256 - 1 / 16) / (15 / 16))


def plain(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(text) // 3
        edited = text[: len(text) - k] + following[:k]
        own, new, after = map(plain_fingerprint, (text, edited, following))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out[doc] = (len(text), sha, own, new, round(plain_likeness(own, new), 9), round(plain_likeness(own, after), 9))
    return out


def sample(seed=4):
    rng = random.Random(seed)
    out = [None, "", " \t\n", "one", "çé ü 𝔘", "a b c d", "a b c d e", "x " * 30_000, "é" * 50_000]
    for _ in range(40):
        out.append(" ".join(f"w{rng.randint(0, 300)}" for _ in range(rng.choice([2, 6, 20, 200, 900]))))
    return out + out[-3:]


def test_rows_equal_a_plain_version(spark, docs, tables):
    rows = [(3 * i - 20, t, "s") for i, t in enumerate(sample())]
    random.Random(1).shuffle(rows)
    got = {}
    for r in QUERY(spark, tables(documents=docs(rows).repartition(5))).collect():
        got[r["doc_id"]] = (*tuple(r)[1:5], round(r["near_edited"], 9), round(r["near_next"], 9))
    assert got == plain([(i, t) for i, t, _ in rows])


def test_text_crosses_one_exchange_only(spark, docs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = fp.neighbour_edits(docs(sample()))
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and "Python" not in plan and "Arrow" not in plan


def test_likeness_estimates_the_share_of_common_shingles(spark, docs):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    pairs = []
    for share in (0.0, 0.2, 0.5, 0.8, 0.95, 1.0):
        for _ in range(12):
            a = rng.choices(words, k=600)
            pairs.append((" ".join(a), " ".join(a[: int(600 * share)] + rng.choices(words, k=600 - int(600 * share)))))
    df = spark.createDataFrame(pairs, "a string, b string")
    df = fp.with_fingerprint(fp.with_fingerprint(df, "a", "fa"), "b", "fb")
    off = []
    for r in df.select("a", "b", fp.likeness(F.col("fa"), F.col("fb")).alias("s")).collect():
        a, b = shingles(r["a"]), shingles(r["b"])
        off.append(r["s"] - len(a & b) / len(a | b))
    assert abs(sum(off) / len(off)) < 0.02 and max(map(abs, off)) < 0.15


def test_repeated_rows_null_ids_and_other_columns(docs):
    rows = [(5, "a b c d e f", "x"), (5, "a b c d e f", "x"), (None, "n o p q r s", "y"), (5, "other text of these", "x"), (1, "z z z", "z")]
    df = docs(rows).withColumn("head", F.lit("h")).withColumn("fingerprint", F.lit(1)).withColumn("n", F.lit(0))
    out = fp.neighbour_edits(df).collect()
    assert sorted(str(r["doc_id"]) for r in out) == ["1", "5", "5", "5", "None"]
    edits = {r["doc_id"]: r["edited_sha256"] for r in out}
    assert edits[1] == hashlib.sha256(b"z z n").hexdigest()


def test_empty_table_and_single_row(docs):
    assert fp.neighbour_edits(docs([])).collect() == []
    (row,) = fp.neighbour_edits(docs(["one two three four five six"])).collect()
    assert row["near_next"] == 1.0
