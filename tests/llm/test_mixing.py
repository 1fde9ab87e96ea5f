"""Targets and draws against plain versions, and the deal of blocks to shards."""

import random
from collections import Counter

import numpy as np
import plain_mixing
import pytest
from pyspark.sql import functions as F

from checks.compare import differences
from stoploom.llm import mixing
from stoploom.llm.oracle import ORACLE
from stoploom.llm.queries import QUERIES

NAME = "op10_mixing"


def sample(seed=2, n=400):
    rng = random.Random(seed)
    sources = ["hot"] * 20 + ["b", "c", "ä", "Z", "", None, "d", "tiny"]
    rows = [(i, " ".join("w" for _ in range(int(rng.paretovariate(1) * 5))), rng.choice(sources)) for i in range(n)]
    rows += [(n, None, "b"), (n + 1, "", "only empty"), (n + 2, " \n", None), (None, "x y z", "c"), (5, "five again", "hot"), (n + 3, "w " * 40_000, "d")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rows_equal_a_plain_version(spark, docs, tables, seed):
    rows = sample(seed)
    goal, times = plain_mixing.targets(rows), plain_mixing.copies(rows)
    got = sorted((str(r["doc_id"]), r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in QUERIES[NAME](spark, tables(documents=docs(rows))).collect())
    want = sorted(
        (str(d), plain_mixing.size(t), goal[s][0], round(goal[s][1], 6), n * plain_mixing.size(t)) for (d, t, s), n in zip(rows, times, strict=True)
    )
    assert got == want
    assert all(taken <= 3 * size for _, size, _, _, taken in got)
    total = sum(plain_mixing.size(t) for _, t, _ in rows)
    assert abs(sum(t for _, t in goal.values()) - total) < 1e-6 * total


def test_taken_comes_near_the_targets(docs):
    rows = [(i, "w " * (20 + i % 50), s) for i, s in enumerate(["a", "b", "c", "d"] * 300)]
    taken, target = Counter(), {}
    for r, (_, _, s) in zip(sorted(mixing.plan(docs(rows)).collect(), key=lambda r: r["doc_id"]), rows, strict=True):
        taken[s] += r["taken"]
        target[s] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 35 for s in target)


def test_sql_agrees(spark, docs, tmp_path):
    docs(sample(9)).toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"}).to_parquet(tmp_path / "documents.parquet")
    assert differences(QUERIES[NAME](spark, str(tmp_path)), str(tmp_path), ORACLE[NAME]) is None


def dealt(spark, quotas, shards, seed=0):
    """[shard, source]: units dealt to shards."""
    units = spark.createDataFrame([(str(k), f"{i}", 1) for k, n in enumerate(quotas) for i in range(n)], "src string, block string, copy long")
    rows = mixing.deal(units.withColumn("mark", F.md5(F.concat_ws(":", F.lit(seed), "src", "block"))), shards).collect()
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    for r in rows:
        out[r["shard"], int(r["src"])] += 1
    return out


def test_tree_deals_exact_quotas(spark):
    quotas = np.array([900, 100, 0, 7])
    for shards in (1, 2, 7, 64):
        found = dealt(spark, quotas, shards)
        assert (found.sum(axis=0) == quotas).all()
        assert found.sum(axis=1).max() - found.sum(axis=1).min() <= 7
    shares = np.mean([dealt(spark, quotas, 4, seed)[0] for seed in range(20)], axis=0)
    assert np.allclose(shares, quotas / 4, atol=8)


def plain_tree(total, shards):
    """Sizes of the shards of a tree."""
    if shards == 1:
        return [total]
    half, left = shards // 2, total * (shards // 2) // shards
    return plain_tree(left, half) + plain_tree(total - left, shards - half)


def test_tree_follows_the_order_of_marks(spark):
    for shards in (1, 3, 6, 13):
        units = spark.range(101).selectExpr("'s' AS src", "CAST(id AS STRING) AS block", "1 AS copy", "md5(CAST(id AS STRING)) AS mark")
        rows = sorted(mixing.deal(units, shards).collect(), key=lambda r: r["mark"])
        sizes = Counter(r["shard"] for r in rows)
        assert [r["shard"] for r in rows] == sorted(r["shard"] for r in rows)
        assert [sizes[k] for k in range(shards)] == plain_tree(101, shards)


def test_shards_follow_the_words(spark, docs):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [mixing.shard_count(spark, n * mixing.SHARD_WORDS) for n in (0, 1, least, 1000)] == [least, least, least, 1000]
    assert mixing.mix(docs(sample(3)), shards=5).rdd.getNumPartitions() == 5


def test_copies_go_to_shards_and_reruns_agree(docs):
    df = docs(sample(4))
    rows = mixing.plan(df, shards=8).collect()
    assert all(len(r["shards"] or ()) == (r["taken"] // r["size"] if r["size"] else 0) for r in rows)
    assert all(0 <= s < 8 for r in rows for s in r["shards"] or ())
    assert sorted(map(str, rows)) == sorted(map(str, mixing.plan(df.repartition(7), shards=8).collect()))


def test_mix_repeats_whole_rows(docs):
    rows = sample(6)
    df = docs(rows).withColumn("copies", F.lit(1)).withColumn("src", F.lit("x"))
    out = mixing.mix(df)
    assert out.columns == df.columns
    want = Counter()
    for (d, t, s), n in zip(rows, plain_mixing.copies(rows), strict=True):
        if n:
            want[d, t, s] += n
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in out.collect()) == want


def test_empty_table(docs):
    assert mixing.plan(docs([])).collect() == []
    assert mixing.mix(docs([])).collect() == []
    assert mixing.mix(docs([None, ""])).collect() == []
