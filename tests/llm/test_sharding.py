"""Placement against a plain descent, and what growth and new weights move."""

import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks.compare import differences
from stoploom.llm import sharding
from stoploom.llm.oracle import ORACLE
from stoploom.llm.queries import QUERIES
from stoploom.llm.sharding import Tree


def plain_shard(key, tree):
    """A descent from sums of weights."""
    name = "null" if key is None else f"={key}"
    here = ""
    for level in range(1, 4):
        weights = Counter()
        for shard, (g, r, w) in enumerate(tree.shards):
            path = "/".join(map(str, (g, r, shard)[:level]))
            if not here or path.startswith(here + "/"):
                weights[path] += w

        def draw(path, weights=weights):
            u = (int(hashlib.md5(f"{name}@{path}".encode()).hexdigest()[:13], 16) + 1) / 16**13
            return math.log(u) / weights[path], path

        here = max(draw(p) for p in weights if weights[p] > 0)[1]
    return int(here.split("/")[-1])


TREES = [Tree.even(2, 2, 4), Tree.even(2, 2, 4).grown(), Tree.even(1, 1, 1), Tree(((0, 0, 1.0), (0, 1, 2.5), (0, 1, 0.0), (3, 0, 4.0)))]


@pytest.mark.parametrize("tree", TREES)
def test_shards_equal_a_plain_descent(spark, tree):
    df = spark.range(400).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    got = {r["id"]: r["shard"] for r in sharding.place(df, "id", tree).collect()}
    assert got == {k: plain_shard(k, tree) for k in [*range(400), None]}


def test_weights_are_shares(spark):
    tree = Tree(((0, 0, 1.0), (0, 1, 2.0), (1, 0, 1.0), (1, 0, 4.0)))
    got = {r["shard"]: r["count"] for r in sharding.place(spark.range(16_000), "id", tree).groupBy("shard").count().collect()}
    assert all(abs(got[k] / 2_000 - w) < 0.12 * w + 0.05 for k, w in enumerate((1, 2, 1, 4)))


def test_a_new_shard_takes_rows_only_into_itself(spark):
    tree = Tree.even(2, 2, 4)
    for size in (16, 17, 18):
        a, b = sharding.shard_of(sharding.key_of(F.col("id")), tree), sharding.shard_of(sharding.key_of(F.col("id")), tree.grown())
        moved = spark.range(6_000).select(a.alias("a"), b.alias("b")).where("a <> b").groupBy("b").count().collect()
        assert [r["b"] for r in moved] == [size] and abs(moved[0]["count"] - 6_000 / (size + 1)) < 90
        tree = tree.grown()


def test_new_weights_move_rows_only_through_changed_subtrees(spark):
    tree = Tree.even(2, 2, 2)
    lighter = tree.weighed(5, 0.25)  # region 1, rack 0
    a, b = (sharding.shard_of(sharding.key_of(F.col("id")), t) for t in (tree, lighter))
    moved = spark.range(8_000).select(a.alias("a"), b.alias("b")).where("a <> b").distinct().collect()
    assert moved
    for r in moved:
        region, rack = (lambda s: s // 4), (lambda s: s // 2)
        if region(r["a"]) == region(r["b"]) == 0:
            raise AssertionError("moved inside a region of the same weights")
        assert region(r["b"]) == 0 or rack(r["a"]) == 2, "a row leaves the lighter region, or its lighter rack, and enters no other"


def rows(n=300):
    out = [(i, "x" * (i % 7) if i % 5 else None, f"s{i % 3}") for i in range(n)]
    return out + [(None, None, None)] * 40 + [(9, "é same", "a")] * 50 + [(None, "t", "a"), (None, "u", "b")]


def test_query_equals_plain_placement(spark, docs, tables):
    got = QUERIES["op11_sharding"](spark, tables(documents=docs(rows()).repartition(5))).collect()
    key = lambda r: (str(r[0]), r[1], r[2], r[3], r[4])
    tree = sharding.TREE
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), plain_shard(i, tree), plain_shard(i, tree.grown())) for i, t, _ in rows())
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got) == want
    assert {r["law"] for r in got} == {"key"}
    for shard in range(16):
        own = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert own == list(range(len(own)))


def test_query_equals_sql(spark, docs, tables):
    path = tables(documents=docs(rows(120)))
    assert differences(QUERIES["op11_sharding"](spark, path), path, ORACLE["op11_sharding"]) is None


def test_many_copies_are_written_in_pieces(spark, docs, monkeypatch):
    monkeypatch.setattr(sharding, "_COPIES", 8)
    got = sharding.assign(docs([(1, "a", "s")] * 61 + [(2, "b", "s")] * 8)).collect()
    assert Counter((r["doc_id"], r["shard"]) for r in got) == {(1, plain_shard(1, sharding.TREE)): 61, (2, plain_shard(2, sharding.TREE)): 8}
    for shard in {r["shard"] for r in got}:
        own = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert own == list(range(len(own)))


def test_slots_do_not_depend_on_partitions(docs):
    df = docs(rows())
    one, other = (sorted(map(str, sharding.assign(x).collect())) for x in (df.coalesce(1), df.repartition(7)))
    assert one == other


def test_clashing_columns_and_folders(spark, docs, tmp_path):
    df = docs(rows(40))
    for name in ("shard", "slot", "size", "_n", "_mark", "_block", "law", "key", "node", "draw"):
        df = df.withColumn(name, F.lit("x"))
    assert sharding.assign(df).count() == 132
    placed = sharding.place(df, into="home")
    assert placed.columns == [*df.columns, "home"]
    sharding.write_shards(df, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 132
    assert back.where("doc_id = 7").first()["shard"] == plain_shard(7, sharding.TREE)


def test_empty_table_and_bad_trees(docs):
    assert sharding.assign(docs([])).collect() == []
    for bad in (Tree(()), Tree(((0, 0, 0.0),)), Tree(((0, 0, 1.0), (0, 0, -1.0)))):
        with pytest.raises(ValueError):
            bad.children()
