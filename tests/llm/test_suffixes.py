"""Removed bytes against a count of every string."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from stoploom.llm import common, suffixes
from stoploom.llm.queries import QUERIES


def plain(texts, length=400):
    data = [(t or "").encode() for t in texts]
    often = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - length + 1):
            if often[d[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
        out.append((len(d), int(gone.sum()), runs, bytes(np.frombuffer(d, np.uint8)[~gone])))
    return out


def sample(seed=6, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(k)) for k in (70, 100, 130, 200, 400)]
    out = [None, "", "short", "x" * 399, "x" * 400, "y" * 401, "z" * 1500, "ab" * 700, "é" * 500, "abc" * 300 + "q" + "abc" * 300]
    for _ in range(n):
        parts = [" ".join(word() for _ in range(rng.choice([0, 1, 30, 150])))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, 40)
            parts += [p[cut:] if rng.random() < 0.5 else p[: len(p) - cut], " ".join(word() for _ in range(rng.choice([0, 1, 60])))]
        out.append(" ".join(parts))
    return [*out, out[-1], out[-2] + "!", "?" + out[-3]]


def digest(rows):
    return {i: (n, gone, runs, hashlib.sha256(kept).hexdigest()) for i, (n, gone, runs, kept) in enumerate(rows)}


@pytest.mark.parametrize("most", [suffixes.BUCKET_RUNS, 0, 3])
def test_digests_equal_a_count_of_every_string(spark, docs, tables, monkeypatch, most):
    """By sorted buckets, by counted ones, and by both."""
    monkeypatch.setattr(suffixes, "BUCKET_RUNS", most)
    texts = sample(6 + most)
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op4_suffix_array_dedup"](spark, tables(documents=docs(texts))).collect()}
    assert got == digest(plain(texts))


def test_pieces_of_long_texts_and_small_batches(docs, monkeypatch):
    monkeypatch.setattr(suffixes, "_PIECE", 500)
    monkeypatch.setattr(suffixes, "BATCH_BYTES", 2000)
    texts = sample(21)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffixes.digests(docs(texts)).collect()}
    assert got == digest(plain(texts))


def test_cover_has_every_difference():
    for period in (16, 25, 64):
        d = suffixes.cover(period)
        assert {(a - b) % period for a in d for b in d} == set(range(period))


def test_runs_cover_every_suffix_once():
    rng = np.random.default_rng(1)
    data = bytes(rng.integers(97, 100, size=5000, dtype=np.uint8))
    runs = suffixes.text_runs(data, 400, suffixes.Windows(suffixes.ANCHOR, suffixes._PIECE + 400))
    assert [k for s, n, *_ in runs for k in range(s, s + n)] == list(range(5000 - 399))
    assert len(runs) < 60 and len({b for *_, b, _ in runs}) == len({s + a for s, _, a, *_ in runs})


def test_window_hashes_depend_on_content_alone():
    rng = np.random.default_rng(3)
    part = rng.integers(0, 256, size=300, dtype=np.uint8)
    data = np.concatenate((rng.integers(0, 256, size=77, dtype=np.uint8), part, part))
    hashes = suffixes.Windows(64, 1000).hashes(data)
    assert (hashes[77 : 77 + 237] == hashes[377 : 377 + 237]).all() and len(set(hashes.tolist())) == len(hashes) - 237


def test_strip_keeps_columns_and_whole_characters(docs):
    shared = "".join(random.Random(2).choices("abcdefghij ", k=500))
    rows = [(1, "é" + shared + "ä", "a"), (2, "è" + shared + "ö", "b"), (2, "è" + shared + "ö", "b"), (None, "own text", "c"), (None, None, "d")]
    df = docs(rows).withColumn("side", F.lit(1)).withColumn("data", F.lit("x")).withColumn("start", F.lit(None))
    out = suffixes.strip(df)
    assert out.columns == df.columns
    got = sorted(((r["doc_id"], r["text"], r["n_chars"], r["side"], r["data"]) for r in out.collect()), key=str)
    # the second row's copy takes all of it; the first keeps its own "é" and no half of its "ä"
    want = [(1, "é", 1, 1, "x"), (2, "", 0, 1, "x"), (2, "", 0, 1, "x"), (None, "own text", 8, 1, "x"), (None, None, None, 1, "x")]
    assert got == sorted(want, key=str)


def test_empty_table(docs):
    assert suffixes.digests(docs([])).collect() == []
    assert suffixes.strip(docs([])).collect() == []


def test_scans_decode_few_rows_of_texts_together(spark, docs, tables):
    """One batch of 1,000 rows before."""
    path = tables(documents=docs([f"{i} text" for i in range(1000)]).coalesce(1))
    QUERIES["op4_suffix_array_dedup"](spark, path).collect()
    scan = spark.read.parquet(f"{path}/documents.parquet").select(F.upper("text"))
    scan.collect()
    plan = scan._jdf.queryExecution().executedPlan()
    while "numInputBatches" not in str(plan.metrics()):
        plan = plan.children().head()
    assert plan.metrics().apply("numInputBatches").value() >= 7
    assert spark.conf.get("parquet.hadoop.vectored.io.enabled") == "false"
    assert spark.conf.get("parquet.read.allocation.size") == str(256 << 10)


def test_hash_columns_of_runs_have_no_dictionaries(docs, monkeypatch):
    kept = {}
    monkeypatch.setattr(suffixes, "keep", lambda df, name, *more: kept.setdefault(name, common.keep(df, name, *more)))
    suffixes.digests(docs(sample(9, 20)))
    encodings = {}
    for part in ds.dataset([f.removeprefix("file://") for f in kept["runs"].inputFiles()]).get_fragments():
        for group in range(part.metadata.num_row_groups):
            columns = part.metadata.row_group(group)
            for column in map(columns.column, range(columns.num_columns)):
                encodings.setdefault(column.path_in_schema, set()).update(column.encodings)
    assert [c for c, e in encodings.items() if "DICTIONARY" in str(e)] == ["id_hash", "text_hash", "start", "size", "ahead"]
