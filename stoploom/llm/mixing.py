"""Mixing sources to target weights, in built-in expressions only.

Targets: sources share the size of all documents by weight; a source's target stops at ``MOST`` times its
size, and what is over is shared anew by weight among the others until none is above.

Draws: the documents of a source lie in ``BLOCKS`` blocks by a hash of their id. Every document is taken
as often as the target covers the source whole; the remainder is drawn without repeats, block after
block in permuted order, up to the document whose middle the remainder reaches.

Shards: each drawn block of a source is a unit. A splitting tree over the shards deals every node's units to its
two halves in exact shares, a multivariate hypergeometric draw over sources, down to one shard (see ``deal``);
a shard's documents are shuffled inside it. There are as many shards as the words take.

Sums over a source are taken by block first, so a source with a third of all rows is many small
windows. What is in one place is one row a source and, within a source, one row a block.

Defined cases: a null source is a source of its own, after all others; a null or blank text has size
0 and is never drawn; rows that repeat a doc_id are drawn one by one; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, word_list

#: Weights of sources in code point order, repeating, and the most a source may grow.
WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_DIGITS = 3
BLOCKS = 16**BLOCK_DIGITS
#: Words of a shard, unless the session's partitions are fewer words each.
SHARD_WORDS = 64_000_000
SEED = 7


def source_key(source: Column) -> Column:
    """Sources in code point order as non-null text, null after all others."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(src, source_size, target) from (src, source_size): one row a source.

    In order of most * size / weight, the first sources are those that stop at their limit; the level
    at which the rest share what is left is the first that no later source's limit undercuts."""
    place = F.row_number().over(Window.orderBy("src")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    weighted = sources.withColumn("weight", weight)
    limit = F.lit(most) * F.col("source_size")
    by_limit = Window.orderBy((limit / F.col("weight")).asc(), "src")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    levels = weighted.withColumn("level", left.cast("double") / F.sum("weight").over(after))
    fits = F.when(F.col("level") * F.col("weight") <= limit, F.col("level"))
    shared = levels.withColumn("fits", fits).withColumn("level", F.first("fits", ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return shared.select("src", "source_size", F.least(limit.cast("double"), F.col("level") * F.col("weight")).alias("target"))


def rows_of(docs: DataFrame, side: Column, source: str = "source", text: str = "text", doc_id: str = "doc_id", seed: int = SEED) -> DataFrame:
    """(side, src, size, mark, block): a document's size, its place in the permutation and its block."""
    mark = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(f":{seed}")))
    return docs.select(
        side.alias("side"), source_key(F.col(source)).alias("src"), F.size(word_list(F.col(text))).cast("long").alias("size"),
        mark.alias("mark"), F.substring(mark, 1, BLOCK_DIGITS).alias("block"),
    )


def deal(units: DataFrame, shards: int) -> DataFrame:
    """``units`` (with ``mark``, a digest) with ``shard``: a splitting tree over shards, in exact shares.

    Units in order of their marks are a random permutation, and a node of the tree is a range of it. A node
    of several shards gives half of them the front of its range, as many units as are their share: a draw
    without replacement, so what each half gets of each source is multivariate hypergeometric and the
    halves add up to the node. Ranks come from totals by the first digits of the mark, then in each of them."""
    digits = F.substring("mark", 1, BLOCK_DIGITS).alias("digits")
    totals = units.groupBy(digits).agg(F.count(F.lit(1)).alias("n"))
    front = Window.orderBy("digits")  # at most 4,096 rows
    starts = totals.select("digits", (F.sum("n").over(front) - F.col("n")).alias("start"), F.sum("n").over(Window.partitionBy()).alias("size"))
    inside = F.row_number().over(Window.partitionBy("digits").orderBy("mark", "src", "block", "copy"))
    ranked = units.select("*", digits).withColumn("at", inside - 1).join(starts, "digits")
    node = ranked.withColumns({"at": F.col("start") + F.col("at"), "shard": F.lit(0), "many": F.lit(shards)})
    for _ in range(max(1, (shards - 1).bit_length())):
        half = F.expr("many DIV 2")
        left = F.expr("(size * (many DIV 2)) DIV many")
        node = node.withColumns({"half": half, "left": left}).withColumn("first", F.col("at") < F.col("left"))
        node = node.select(
            *units.columns,
            F.when(F.col("first"), F.col("at")).otherwise(F.col("at") - F.col("left")).alias("at"),
            F.when(F.col("first"), F.col("left")).otherwise(F.col("size") - F.col("left")).alias("size"),
            F.when(F.col("first"), F.col("shard")).otherwise(F.col("shard") + F.col("half")).cast("int").alias("shard"),
            F.when(F.col("first"), F.col("half")).otherwise(F.col("many") - F.col("half")).alias("many"),
        )
    return node.select(*units.columns, "shard")


def shard_count(spark: SparkSession, words: int) -> int:
    """As many shards as the words take, and no fewer than the session has partitions after an exchange."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words // SHARD_WORDS))


def draws(rows: DataFrame, shards: int | None = None, seed: int = SEED, sizes: DataFrame | None = None) -> DataFrame:
    """(side, src, size, source_size, target, copies, shards) of ``rows_of``; ``shards``: where each copy goes.

    ``shards`` given is their number, else ``shard_count`` of the words of all rows.

    ``sizes``: the same rows without ``side``, if they are cheaper to read than to compute again."""
    sizes = rows.select("src", "size", "block") if sizes is None else sizes
    blocks = keep(sizes.groupBy("src", "block").agg(F.sum("size").alias("block_size")), "blocks")
    sources = targets(blocks.groupBy("src").agg(F.sum("block_size").alias("source_size")))
    sources = sources.withColumn("times", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    sources = keep(sources.withColumn("rest", F.col("target") - F.col("times") * F.col("source_size")), "targets")
    in_source = Window.partitionBy("src").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("start", F.coalesce(F.sum("block_size").over(in_source), F.lit(0))).join(sources, "src")
    # units of a block: one for each time the source is taken whole, one more where the remainder reaches
    parts = F.when(F.col("block_size") > 0, F.col("times") + (F.col("start") < F.col("rest")).cast("long")).otherwise(0)
    units = placed.where(parts > 0).select("src", "block", F.explode(F.sequence(F.lit(1).cast("long"), parts)).alias("copy"))
    mark = F.md5(F.concat_ws(":", "src", "block", F.col("copy").cast("string"), F.lit(f"{seed}")))
    if shards is None:
        shards = shard_count(rows.sparkSession, blocks.agg(F.sum("block_size")).first()[0] or 0)
    dealt = deal(units.withColumn("mark", mark), shards)
    homes = dealt.groupBy("src", "block").agg(F.array_sort(F.collect_list(F.struct("copy", "shard"))).alias("homes"))
    known = placed.join(homes, ["src", "block"], "left").select("src", "block", "start", "source_size", "target", "times", "rest", "homes")
    in_block = Window.partitionBy("src", "block").orderBy("mark", "size").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("before", F.coalesce(F.sum("size").over(in_block), F.lit(0)))
    joined = ranked.join(known, ["src", "block"])
    # in halves of a word, so that the middle of a document is a whole number
    reached = 2 * (F.col("start") + F.col("before")) + F.col("size") <= 2 * F.col("rest")
    copies = F.when(F.col("size") > 0, F.col("times") + reached.cast("long")).otherwise(0)
    joined = joined.withColumn("copies", copies)
    return joined.select(
        "side", "src", "size", "source_size", "target", "copies",
        F.slice(F.transform("homes", lambda h: h["shard"]), F.lit(1), F.col("copies").cast("int")).alias("shards"),
    )


def plan(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, shards) of every row of (doc_id, text, source).

    ``taken`` counts the words of the copies that were dealt to a shard."""
    rows = keep(rows_of(docs, F.struct("doc_id"), seed=seed), "sizes")
    drawn = draws(rows, shards, seed)
    taken = (F.coalesce(F.array_size("shards"), F.lit(0)) * F.col("size")).alias("taken")
    return drawn.select(F.col("side.doc_id").alias("doc_id"), "size", "source_size", "target", taken, "copies", "shards")


def mix(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """The mixture: rows of ``docs`` as often as they are drawn, by shard, shuffled inside it."""
    rows = rows_of(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]), seed=seed)
    sizes = keep(rows.select("src", "size", "block"), "sizes")
    if shards is None:
        shards = shard_count(docs.sparkSession, sizes.agg(F.sum("size")).first()[0] or 0)
    drawn = draws(rows, shards, seed, sizes)
    copies = drawn.select("side", F.posexplode("shards").alias("copy", "shard"))
    order = F.xxhash64(F.lit(seed), "copy", F.col("side").getField("doc_id"), F.col("side").getField("text"))
    # a shard is a partition
    dealt = copies.withColumn("order", order).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "order")
    return dealt.select(*[F.col("side").getField(c).alias(c) for c in docs.columns])
