"""A training corpus from ``documents`` in five stages, each a table that the next one reads.

Quality rules drop documents that repeat themselves; SimHash near-dedup keeps one row of each group
of near copies; suffix-array dedup takes passages that stand in several places out of the texts;
mixing draws documents so that sources reach their target weights (a document may come up to three
times); BPE encoding turns what is left into ids.

Every stage works on all that the one before it kept. All but the last return the columns of their
input; null, empty and repeated rows are treated as the operators say. An empty table passes
through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stoploom.llm import bpe, mixing, quality, simhash, suffixes
from stoploom.llm.common import keep, table
from stoploom.llm.queries import VOCABULARY

#: Bytes of a passage that goes if it stands twice: 51 words of three letters and a blank.
PASSAGE = 200

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_clean(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.strip(docs, PASSAGE)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, bpe.load(public_tokenizers.path(VOCABULARY)))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mixing_to_targets", mixing_to_targets),
    ("bpe_encoding", bpe_encoding),
]

#: SQL has no XXH64 of shingles, no byte strings of overlapping passages and no BPE: the stages are
#: tested against brute-force versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
