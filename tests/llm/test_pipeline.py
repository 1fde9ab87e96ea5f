"""The stages one after the other against plain versions of them."""

import random

import plain_mixing
import tokenizers
from pyspark.sql import functions as F
from test_bpe import PATH
from test_bpe import plain as plain_bpe
from test_quality import plain as plain_quality
from test_simhash import plain_groups
from test_suffixes import plain as plain_suffixes

import corpus_pipeline


def sample(seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeéfghijklm", k=rng.randint(2, 9)))
    passages = [" ".join(word() for _ in range(90)) for _ in range(3)]
    rows = []
    for i in range(70):
        text = " ".join(word() for _ in range(rng.choice([10, 40, 200])))
        if rng.random() < 0.5:
            text += " " + rng.choice(passages) + " " + word()
        rows.append((i, text, rng.choice(["a", "b", "c", None])))
    rows += [(100 + k, rows[k][1], "b") for k in range(10)]
    rows += [(200 + k, rows[k + 20][1] + " tail", "a") for k in range(10)]
    rows += [(300, None, "a"), (301, "", "b"), (302, "again and again " * 50, "c")]
    rng.shuffle(rows)
    return rows


def test_stages_equal_plain_versions(spark, docs, tables):
    rows = sample()
    where = tables(documents=docs(rows))
    kept = [r for r in rows if plain_quality(r[1])[-1]]
    groups = {d: c for d, _, c in plain_groups([(d, t) for d, t, _ in kept])}
    first = [r for r in kept if groups[r[0]] == r[0]]
    cut = [(d, k[3].decode(errors="ignore"), s) for (d, _, s), k in zip(first, plain_suffixes([t for _, t, _ in first], corpus_pipeline.PASSAGE), strict=True)]
    mixed = [r for r, n in zip(cut, plain_mixing.copies(cut), strict=True) for _ in range(n)]
    library = tokenizers.Tokenizer.from_file(PATH)
    want = sorted((d, *plain_bpe(library, t)) for d, t, _ in mixed)
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, where).collect())
    assert got == want and len(kept) < len(rows) and len(first) < len(kept) and len(mixed) > 10


def test_one_row_of_each_group_stays(spark, docs, tables):
    """Repeated rows, one id with two texts, and copies without ids; each text comes out whole, once."""
    rng = random.Random(8)
    a, b, c, d, e = (" ".join("".join(rng.choices("abcdefghijklm", k=rng.randint(4, 9))) for _ in range(120)) for _ in range(5))
    rows = [(1, a, "x")] * 3 + [(2, b, "y"), (2, b, "x"), (9, b, "x")] + [(None, c, "x")] * 4 + [(None, d, "x"), (3, d, "x")]
    rows += [(4, e, "x"), (4, e + " tail", "x"), (5, "", "x")]
    out = corpus_pipeline.simhash_near_dedup(spark, docs(rows).repartition(5), "")
    got = sorted(((r["doc_id"], r["text"], r["source"]) for r in out.collect()), key=str)
    either = [r for r in got if r[0] == 4]
    assert len(either) == 1 and either[0] in rows
    assert [r for r in got if r[0] != 4] == sorted([(1, a, "x"), (2, b, "x"), (None, c, "x"), (3, d, "x"), (5, "", "x")], key=str)
    encoded = [r["doc_id"] for r in corpus_pipeline.run(spark, tables(documents=docs(rows))).collect()]
    assert {1, 2, 3, 4, None} <= set(encoded)


def test_passages_of_51_words_go_and_clean_texts_stay(spark, docs):
    rng = random.Random(2)
    text = lambda n: " ".join("".join(rng.choices("abcdefghijklm", k=rng.choice([2, 3, 4, 5, 7, 8]))) for _ in range(n))
    passages, clean = [text(51) for _ in range(6)], [text(120) for _ in range(10)]
    rows = [f"{text(80)} {p} {text(60)}" for p in passages for _ in range(3)]
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.suffix_array_dedup(spark, docs(rows + clean), "").collect()}
    for k in range(len(rows)):
        left = set(zip(*[passages[k // 3].split()[i:] for i in range(8)], strict=False)) & set(zip(*[out[k].split()[i:] for i in range(8)], strict=False))
        assert not left and len(out[k].split()) >= 130
    assert [out[len(rows) + k] for k in range(10)] == clean


def test_stages_keep_columns_of_any_name(spark, docs):
    names = ["quality", "root", "fp", "data", "side", "copies", "shards", "start", "n", "absent", "id", "hash", "rows", "row", "__null", "__id", "__hash", "__rows", "__measured", "__quality"]
    df = docs(sample(6)).select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, "")
        assert out.columns == df.columns
        assert out.select(*names).distinct().collect() == [tuple(range(len(names)))]
    assert [name for name, _ in corpus_pipeline.STAGES][:2] == ["quality_rules", "simhash_near_dedup"]


def test_empty_documents(spark, docs, tables):
    assert corpus_pipeline.run(spark, tables(documents=docs([]))).collect() == []
