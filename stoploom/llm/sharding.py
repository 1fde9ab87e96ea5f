"""Shards by a weighted hash tree: region, then rack, then shard.

A key descends from the root. At each node every child draws ln(u) / weight, u a number in (0, 1] from a
digest of the key and the child's name, and the largest draw wins, so a child gets its weight's share
and a child's draw depends on nothing but the key, its name and its weight. When a weight changes,
only draws of the nodes above it change: rows move only into or out of subtrees whose weights change. A shard that
is added as a region of its own (``Tree.grown``) takes rows into itself and moves no other row.

A node's weight is the sum of its shards' weights; nodes of no weight draw nothing. Placement is a column
expression: no shuffle, no other column touched. Slots number the rows of a shard from 0 without gaps.
They follow the order of a digest of the row, so they depend neither on files nor on tasks: equal rows are
counted first, a shard is cut into blocks by the first digits of the digest, blocks are added up in one window
over their totals, and rows are numbered inside their block. Neither a hot key nor a hot text meets in one task:
equal rows travel as one row with a count and are written out again in pieces.

Defined cases: a null key is a key of its own; rows that repeat a key stand in one shard with a slot each; a null text has
size 1 and checksum 0; other columns, whatever their names, are never looked at by ``slots`` and kept by ``place``;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

#: Hexadecimal digits of a digest in a draw, and in the number of a block.
DRAW_DIGITS = 13
BLOCK_DIGITS = 3
#: Copies of one row that are written out together.
_COPIES = 1 << 16


@dataclass(frozen=True)
class Tree:
    """``shards``: (region, rack, weight) of shard 0, 1, ..."""

    shards: tuple[tuple[int, int, float], ...]

    @staticmethod
    def even(regions: int, racks: int, shards: int) -> Tree:
        """``shards`` of weight 1 in each of ``racks`` racks in each of ``regions`` regions."""
        return Tree(tuple((g, r, 1.0) for g in range(regions) for r in range(racks) for _ in range(shards)))

    def grown(self, weight: float = 1.0) -> Tree:
        """One more shard, in a region of its own: it takes rows only into itself."""
        return Tree((*self.shards, (max((g for g, _, _ in self.shards), default=-1) + 1, 0, weight)))

    def weighed(self, shard: int, weight: float) -> Tree:
        g, r, _ = self.shards[shard]
        return replace(self, shards=(*self.shards[:shard], (g, r, weight), *self.shards[shard + 1 :]))

    def children(self) -> list[dict[str, list[tuple[str, float]]]]:
        """For each level, the children of each node with their weights, those of no weight left out."""
        levels: list[dict[str, dict[str, float]]] = [{}, {}, {}]
        for shard, (region, rack, weight) in enumerate(self.shards):
            if weight < 0:
                raise ValueError("weights are not negative")
            path = ["", f"{region}", f"{region}/{rack}", f"{region}/{rack}/{shard}"]
            for level in range(3):
                node = levels[level].setdefault(path[level], {})
                node[path[level + 1]] = node.get(path[level + 1], 0.0) + weight
        if not any(levels[0].get("", {}).values()):
            raise ValueError("a tree needs a shard of some weight")
        return [{k: [(n, w) for n, w in v.items() if w > 0] for k, v in level.items()} for level in levels]


#: Two regions of two racks of four shards.
TREE = Tree.even(2, 2, 4)


def key_of(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def _draw(key: Column, name: Column, weight: Column) -> Column:
    digits = F.substring(F.md5(F.concat(key, F.lit("@"), name)), 1, DRAW_DIGITS)
    u = (F.conv(digits, 16, 10).cast("double") + 1) / F.lit(float(16**DRAW_DIGITS))
    return F.log(u) / weight


def shard_of(key: Column, tree: Tree = TREE) -> Column:
    """The shard of a key, an int: three descents."""
    node = F.lit("")
    for level in tree.children():
        entries = [(F.lit(parent), F.array(*[F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight")) for n, w in found])) for parent, found in level.items() if found]
        options = F.element_at(F.create_map(*[x for entry in entries for x in entry]), node)
        drawn = F.transform(options, lambda c: F.struct(_draw(key, c["name"], c["weight"]).alias("draw"), c["name"].alias("name")))
        node = F.array_max(drawn)["name"]
    return F.element_at(F.split(node, "/"), -1).cast("int")


def place(docs: DataFrame, key: str = "doc_id", tree: Tree = TREE, into: str = "shard") -> DataFrame:
    """``docs`` with the column ``into``: the shard of each row. A column of that name is replaced."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != into]
    return docs.select(*rest, shard_of(key_of(F.col(f"`{key}`")), tree).alias(into))


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", tree: Tree = TREE, into: str = "shard") -> None:
    """Parquet below ``path``, a folder for each shard; large shards are many files."""
    place(docs, key, tree, into).hint("rebalance", into).write.partitionBy(into).parquet(path)


def slots(rows: DataFrame, shard: str, by: Sequence[str]) -> DataFrame:
    """``rows`` (columns ``shard`` and ``by``) with ``slot``: 0, 1, ... in each shard.

    Rows are in order of a digest of ``by``, then of ``by`` itself; equal rows stand in a row."""
    parts = [key_of(F.col(c)) for c in by]
    equal = rows.groupBy(shard, *by).agg(F.count(F.lit(1)).alias("_n"))
    marked = keep(equal.withColumn("_mark", F.md5(F.concat_ws("|", *parts))), "slots")
    block = F.substring("_mark", 1, BLOCK_DIGITS)
    totals = marked.groupBy(shard, block.alias("_block")).agg(F.sum("_n").alias("_total"))
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(shard, "_block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    in_block = Window.partitionBy(shard, "_block").orderBy("_mark", *by).rowsBetween(Window.unboundedPreceding, -1)
    ranked = marked.withColumn("_block", block).withColumn("_before", F.coalesce(F.sum("_n").over(in_block), F.lit(0)))
    first = ranked.join(starts, [shard, "_block"]).withColumn("_first", F.col("_start") + F.col("_before"))
    # copies in pieces, large counts over several tasks
    begins = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(_COPIES).cast("long"))).alias("_from")
    few = first.where(F.col("_n") <= _COPIES).select(shard, *by, "_n", "_first", F.lit(0).cast("long").alias("_from"))
    many = first.where(F.col("_n") > _COPIES).select(shard, *by, "_n", "_first", begins).repartition(*by, "_from")
    last = F.least(F.col("_from") + _COPIES, F.col("_n")) - 1
    every = few.union(many).select(shard, *by, "_first", F.explode(F.sequence("_from", last)).alias("_copy"))
    return every.select(shard, *by, (F.col("_first") + F.col("_copy")).alias("slot"))


def assign(docs: DataFrame, tree: Tree = TREE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    Size: UTF-8 bytes plus 1. ``grown_shard``: where the row stands in a tree of one more shard."""
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    slim = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
    )
    key = key_of(F.col("doc_id"))
    placed = slim.select("*", shard_of(key, tree).alias("shard"))
    numbered = slots(placed, "shard", ["doc_id", "size", "text_crc32"])
    grown = shard_of(key, tree.grown()).alias("grown_shard")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", grown)
