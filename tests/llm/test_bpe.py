"""Ids and decoded texts against the tokenizers library itself."""

import hashlib
import json
import random

import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from stoploom.llm import bpe
from stoploom.llm.queries import QUERIES, VOCABULARY

PATH = public_tokenizers.path(VOCABULARY)
SPEC = bpe.load(PATH)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def texts(seed=8):
    rng = random.Random(seed)
    marks = ["<|startoftext|>", "<|endoftext|>", "<|", "|>", "'s", "'LL", "don't", "İstanbul", "ΟΔΟΣ", "ß", "ſ", "Å", "Å", "한글", "각", "１２", "½", "²", "\x1c", "\x85", " ", "​", "😀👍🏽", "ǅ", "ﬁ", "\xa0", "_", "\x00", "日本語", "ა", "١٢", "Ω", "ə", "ʼn", "ŉ", "ẞ", "!!'", "'S", "a'b"]
    out = [None, "", " \t\n", "Hello  World", "'" * 9, "x" * 3_000, "ab " * 30_000, "é" * 4_000]
    for _ in range(120):
        parts = [rng.choice(marks) if rng.random() < 0.3 else "".join(rng.choices("abcdeABC123.,-'éÉ", k=rng.randint(1, 9))) for _ in range(rng.randint(1, 60))]
        out.append("".join(p + rng.choice(["", " ", "  ", "\n"]) for p in parts))
    return out + out[-4:]


def plain(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_digests_equal_the_library(spark, docs, tables, library):
    sample = texts()
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op6_bpe_encoding"](spark, tables(documents=docs(sample))).collect()}
    assert got == {i: plain(library, t) for i, t in enumerate(sample)}


@pytest.mark.parametrize("size", [1, 40, 1 << 18])
def test_blocks_of_any_size_give_the_same_ids(docs, library, monkeypatch, size):
    monkeypatch.setattr(bpe, "BLOCK_WORDS", size)
    monkeypatch.setattr(bpe, "_ROW_WORDS", 7)
    monkeypatch.setattr(bpe, "_PACKED", 5)
    sample = texts(9)
    rows = bpe.encode(docs(sample).repartition(3), SPEC).collect()
    got = {r["doc_id"]: bpe.unpack(r["ids"], r["n_tokens"]) for r in rows}
    assert got == {i: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(sample)}


def test_texts_cross_one_exchange(spark, docs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = bpe.digests(docs(texts(11)), SPEC)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan


def test_decode_of_encoded(docs, library):
    sample = texts(10)
    got = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(docs(sample), SPEC), SPEC).collect()}
    assert got == {i: library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for i, t in enumerate(sample)}


def test_repeated_rows_null_ids_and_other_columns(docs, library):
    rows = [(4, "zebra quilt", "a"), (4, "zebra quilt", "a"), (None, "quilt of zebras", "b"), (4, "another text", "c"), (None, None, "d")]
    df = docs(rows).withColumn("word", F.lit("w")).withColumn("n", F.lit(1)).withColumn("ids", F.lit("i")).withColumn("rare", F.lit(0))
    got = sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in bpe.digests(df, SPEC).collect())
    assert got == sorted((str(i), *plain(library, t)) for i, t, _ in rows)


def test_empty_table(docs):
    assert bpe.digests(docs([]), SPEC).collect() == []


def test_other_kinds_of_tokenizer_files_are_refused():
    other = json.loads(SPEC) | {"normalizer": {"type": "Sequence", "normalizers": [{"type": "NFKC"}]}}
    with pytest.raises(ValueError):
        bpe.Splitter(json.dumps(other))


def test_ids_are_joined_with_the_vocabulary(spark, docs):
    """Pieces come from the joined table; both exchanges by block are used twice."""
    pieces = {r["id"]: r["piece"] for r in bpe.vocabulary(spark, SPEC).collect()}
    assert pieces == bpe.Splitter(SPEC).pieces()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = bpe.digests(docs(texts(11)), SPEC)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("ReusedExchange") >= 2 and "SortMergeJoin" in plan


@pytest.mark.parametrize("size", [1, 200])
def test_decode_in_blocks_of_any_size(docs, library, monkeypatch, size):
    monkeypatch.setattr(bpe, "_BLOCK_IDS", size)
    sample = texts(12)[:70]
    encoded = bpe.encode(docs(sample).repartition(3), SPEC).withColumn("block", F.lit(1)).withColumn("piece", F.lit("p"))
    got = {r["doc_id"]: r["text"] for r in bpe.decode(encoded, SPEC).collect()}
    assert got == {i: library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for i, t in enumerate(sample)}


def test_remembered_chunks_are_bounded_by_characters(monkeypatch):
    monkeypatch.setattr(bpe, "_REMEMBERED", 30)
    splitter, plain = bpe.Splitter(SPEC), bpe.Splitter(SPEC)
    for k in range(50):
        text = f"word{k} {'x' * 400}"
        assert splitter.words(text) == plain.rare_words(text)
        assert sum(map(len, splitter.known)) < 30 + bpe._LONG_CHUNK and max(map(len, splitter.known)) <= bpe._LONG_CHUNK
