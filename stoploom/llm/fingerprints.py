"""Document fingerprints by one-permutation MinHash, in built-in expressions only.

Every shingle of ``SHINGLE_WORDS`` words is hashed once. The top 8 bits of a hash choose one of 256
bins, each bin keeps its smallest hash. An empty bin copies a full one: probes that depend only on
the bin and the attempt are tried until one is full (optimal densification, so that equal bins of
two texts copy from equal places). Of each bin the low 4 bits are stored, one hex digit a bin.

Two texts agree in a bin with probability J + (1 - J) / 16, so ``likeness`` corrects the share of
equal digits for agreement by chance.

Defined cases: a text of fewer words has its whole word sequence as its one shingle, and so has a text
without words (null or blank: the empty sequence), so texts without words are alike. Rows that
repeat a doc_id are each fingerprinted; the text that stands for the id as "next document" is the
one with the smallest hash. A null doc_id orders after all others. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, same, word_list

SHINGLE_WORDS = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
DIGIT_BITS = 4
#: Attempts to fill an empty bin before all full bins are ranked for it.
PROBES = 24

_IN_BIN = (1 << (64 - BIN_BITS)) - 1
_DIGITS = "0123456789abcdef"


def _stage(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A step of its own, so that a value used in a lambda is computed once a row."""
    return df.withColumn(name, value)


def with_fingerprint(df: DataFrame, text: str, into: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` with the fingerprint of column ``text`` as ``BINS`` hex digits."""
    none = lambda v: v.bitwiseAND(F.lit(_IN_BIN)) == F.lit(_IN_BIN)  # noqa: E731  no shingle fell into the bin
    names = df.columns
    # the largest hash of every bin marks an empty one; sorting brings each bin's smallest to its front
    marks = F.transform(F.sequence(F.lit(-BINS // 2), F.lit(BINS // 2 - 1)), lambda b: F.shiftleft(b.cast("long"), 64 - BIN_BITS).bitwiseOR(F.lit(_IN_BIN)))
    df = _stage(df, "__words", word_list(F.col(text)))
    starts = F.sequence(F.lit(1), F.greatest(F.size("__words") - F.lit(shingle_words - 1), F.lit(1)))
    df = _stage(df, "__hashes", F.transform(starts, lambda i: F.xxhash64(F.slice("__words", i, F.lit(shingle_words)))))
    df = _stage(df, "__sorted", F.sort_array(F.concat("__hashes", marks)))
    bin_of = lambda v: F.shiftright(v, 64 - BIN_BITS)
    first = lambda v, i: (i == 0) | (bin_of(v) != bin_of(F.get("__sorted", i - 1)))
    df = _stage(df, "__bins", F.filter("__sorted", first))
    full = F.filter(F.transform("__bins", lambda v, k: F.when(~none(v), k)), lambda k: k.isNotNull())
    df = _stage(df, "__full", full)

    def fill(v: Column, b: Column) -> Column:
        def attempt(got: Column, t: Column) -> Column:
            there = F.get("__bins", F.pmod(F.xxhash64(b, t), F.lit(BINS)).cast("int"))
            return F.coalesce(got, F.when(~none(there), there))

        tried = F.aggregate(F.sequence(F.lit(1), F.lit(PROBES)), F.lit(None).cast("long"), attempt)
        ranked = F.array_min(F.transform("__full", lambda k: F.struct(F.xxhash64(b, k, F.lit(0)), k.alias("k"))))
        return F.when(none(v), F.coalesce(tried, F.get("__bins", ranked["k"]))).otherwise(v)

    digit = lambda v: F.substring(F.lit(_DIGITS), v.bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int") + 1, F.lit(1))
    digits = F.transform(F.transform("__bins", fill), digit)
    return df.select(*names, F.array_join(digits, "").alias(into))


def likeness(left: Column, right: Column) -> Column:
    """Estimated share of common shingles of two fingerprints, 0 to 1, corrected for chance."""
    number = lambda x, i: F.conv(F.substring(x, i * 16 + 1, F.lit(16)), 16, -10).cast("long")
    ones = F.lit(0x1111111111111111)

    def unequal(i: Column) -> Column:
        x = number(left, i).bitwiseXOR(number(right, i))
        any_bit = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseOR(F.shiftrightunsigned(x, 3))
        return F.bit_count(any_bit.bitwiseAND(ones))

    parts = F.transform(F.sequence(F.lit(0), F.lit(BINS * DIGIT_BITS // 64 - 1)), unequal)
    differ = F.aggregate(parts, F.lit(0), lambda a, x: a + x)
    chance = 1.0 / (1 << DIGIT_BITS)
    return F.greatest(F.lit(0.0), (1 - differ / F.lit(float(BINS)) - chance) / F.lit(1 - chance))


def next_in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, next_id, pick, n): the id after each in descending order, the first after the last;
    ``pick`` names the text that stands for the id, ``n`` is the longest length under it.

    Ids are dealt by range, so that no task sees them all; the edges between ranges are one row a
    range partition, which is what is broadcast."""
    ids = docs.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("pick"), F.max(F.char_length("text")).alias("n"))
    down = F.col("doc_id").desc_nulls_last()
    ids = keep(ids.repartitionByRange(down).withColumn("range", F.spark_partition_id()), "ids")
    inside = Window.partitionBy("range").orderBy(down)
    heads = ids.withColumn("at", F.row_number().over(inside)).where("at = 1").select("range", F.struct("doc_id").alias("head"))
    ring = Window.orderBy("range")  # one row for each range
    after = F.coalesce(F.lead("head").over(ring), F.first("head").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    edges = heads.select("range", after.alias("head"))
    led = ids.withColumn("led", F.lead(F.struct("doc_id")).over(inside))
    chained = led.join(F.broadcast(edges), "range").withColumn("next", F.coalesce("led", "head"))
    return chained.select("doc_id", F.col("next.doc_id").alias("next_id"), "pick", "n")


def neighbour_edits(docs: DataFrame) -> DataFrame:
    """Every text with its fingerprint, that of its edited text (the last third replaced by the head
    of the next document in descending doc_id) and the likeness to it and to the next document.

    The text crosses one exchange by doc_id, used twice: once to cut the heads that others ask
    for, once to receive them. Heads hold at most a third of the asking text's length."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = keep(next_in_order(base), "order")
    base = with_fingerprint(base, "text", "fingerprint")
    # what is asked of each document; "mine" is the pick of the document asked
    asks = order.select(F.col("next_id").alias("asked"), F.col("doc_id").alias("asker"), F.floor(F.col("n") / 3).cast("int").alias("k"))
    mine = order.select(F.col("doc_id").alias("id"), F.col("pick").alias("mine"))
    asks = asks.join(mine, same(F.col("asked"), F.col("id"))).select("asked", "asker", "k", "mine")
    picked = F.xxhash64("text").bitwiseXOR(F.col("mine")) == 0  # no join key, or the exchange would not be shared
    given = base.join(asks, same(F.col("doc_id"), F.col("asked")) & picked)
    heads = given.select("asker", F.substring("text", F.lit(1), F.col("k")).alias("head"), F.col("fingerprint").alias("next_print"))
    heads = heads.groupBy("asker").agg(F.min("head").alias("head"), F.min("next_print").alias("next_print"))
    both = base.join(heads, same(F.col("doc_id"), F.col("asker")))
    n = F.char_length("text")
    k = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - k), F.substring("head", F.lit(1), k))
    both = both.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fingerprint", "next_print")
    both = with_fingerprint(both, "edited", "edited_fingerprint")
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
    )
