"""One query for each operator, over its whole table; the columns that the contracts name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, chat, fingerprints, html, mixing, quality, repair, sharding, simhash, suffixes, urls, warc
from .common import scratch, table

#: The tokenizer file that op6 and the pipeline use.
VOCABULARY = "word_bpe_49k.json"
#: The tokenizer files that op12 aligns.
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbour_edits(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), scratch(spark, "warc"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(table(spark, sf_dir, "documents"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries of five lists, derived from the hosts, paths and URLs of all pages: which ones are listed, and
    when, follows from a digest of the pattern."""
    host = urls.host_of(F.col("url"))
    labels = F.split(host, r"\.")
    first = F.get(F.filter(F.split(urls.path_of(F.col("url")), "/"), lambda s: s != ""), F.lit(0))
    number = F.conv(F.substring(F.md5("pattern"), 1, 6), 16, 10).cast("int").alias("v")
    pattern = {
        "host": host,
        "site": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2))),
        "path": F.concat_ws("/", host, first),
        "url": F.regexp_replace("url", "#.*$", ""),
    }
    rules = [  # name, blocks, kind, pattern of, which, first day, later listings
        ("malware", True, "domain", "host", "v % 3 = 0", "v % 200", True),
        ("malware", True, "domain", "host", "v % 6 = 0", "v % 200 + 30 + v % 90", False),
        ("malware", True, "domain", "host", "v % 15 = 0", "v % 200 + 150", True),
        ("adult", True, "domain", "site", "v % 7 = 0", "v % 300", True),
        ("ads", True, "path", "path", "v % 5 = 0", "v % 250", True),
        ("ads", True, "path", "path", "v % 5 = 0", "v % 250 + 60", False),
        ("partners", False, "domain", "host", "v % 4 = 1", "v % 100", True),
        ("takedown", True, "url", "url", "v % 11 = 0", "v % 360", True),
    ]
    known = pages.where(host.isNotNull())
    numbered = {k: known.select(c.alias("pattern")).distinct().select("pattern", number) for k, c in pattern.items()}
    parts = [
        numbered[of].where(which).select(
            F.lit(name).alias("list"), F.lit(blocks).alias("blocks"), F.lit(kind).alias("kind"), "pattern",
            F.expr(f"date_add(DATE '2024-01-01', {day})").alias("day"), F.lit(listed).alias("listed"),
        )
        for name, blocks, kind, of, which, day, listed in rules
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged on its fetch day, a day of 2024 that its page_id tells."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = pages.withColumn("day", F.expr("date_add(DATE '2024-01-01', CAST(page_id % 366 AS INT))"))
    return urls.judge(fetched, urls.validity(list_entries(pages)))


def op6_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.load(public_tokenizers.path(VOCABULARY)))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality.repetition(docs).select("doc_id", *[F.col(f"quality.{n}").alias(n) for n in names])


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.read_back(chat.windows(turns), in_order=True)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", "taken")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), alignment.load(*map(public_tokenizers.path, ALIGNED)))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_warc": op3_warc,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_url_filters": op5_url_filters,
    "op6_bpe_encoding": op6_bpe_encoding,
    "op7_quality_rules": op7_quality_rules,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_html_extraction": op9_html_extraction,
    "op10_mixing": op10_mixing,
    "op11_sharding": op11_sharding,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_conversation_repair": op13_conversation_repair,
}
