"""Quality measures against a plain count, and against the SQL."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from checks.compare import differences
from stoploom.llm import quality
from stoploom.llm.oracle import ORACLE
from stoploom.llm.queries import QUERIES

NAME = "op7_quality_rules"


def covered(words, n, before=False):
    """Places of words in windows that occur twice or more; with ``before`` in windows that occurred before."""
    windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    often, seen, hit = Counter(windows), set(), set()
    for i, w in enumerate(windows):
        if w in seen if before else often[w] > 1:
            hit.update(range(i, i + n))
        seen.add(w)
    return hit


LIMITS = {3: 0.30, 4: 0.27, 5: 0.24, 6: 0.22, 7: 0.20, 8: 0.18, 9: 0.165, 10: 0.15}


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars = sum(map(len, words))
    repeat = len(covered(words, 8))
    failed = len(words) < 20 or 100 * repeat > 30 * len(words)
    seen, dup, dup_chars = set(), 0, 0
    for line in lines:
        if line in seen:
            dup, dup_chars = dup + 1, dup_chars + sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", line)))
        seen.add(line)
    kept = not failed and dup_chars <= 0.30 * chars
    for n, most in LIMITS.items():
        kept = kept and sum(len(words[i]) for i in covered(words, n, before=True)) <= most * chars
    return (len(words), chars, sum(c in "#*$%&|<>" for c in text), dup, repeat, failed, kept)


def sample(seed=3):
    rng = random.Random(seed)
    out = [None, "", " \n \t", "one", "|".join("#*$%&|<>"), "ab " * 50_000, "é ü \x0b ß\x0c" * 30, " ".join("abc") + "\n" * 9]
    for _ in range(150):
        words = [f"w{rng.randint(0, 10 ** rng.randint(0, 4))}" for _ in range(rng.choice([5, 19, 20, 60, 400]))]
        for _ in range(rng.randint(0, 3)):
            at, n = rng.randrange(len(words)), rng.randint(1, 30)
            words += words[at : at + n]
        out.append("".join(w + rng.choice([" ", "  ", "\n", "\t", "\r\n"]) for w in words))
    return out


def test_measures_equal_a_plain_count(spark, docs, tables):
    texts = sample()
    where = tables(documents=docs(texts))
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES[NAME](spark, where).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_sql_agrees(spark, docs, tmp_path):
    docs(sample(9)).coalesce(1).toPandas().to_parquet(tmp_path / "documents.parquet")
    assert differences(QUERIES[NAME](spark, str(tmp_path)), str(tmp_path), ORACLE[NAME]) is None


def test_filter_keeps_whole_rows(docs):
    clean = " ".join(f"word{i}" for i in range(50))
    df = docs([clean, "too short", clean, None, "again and again " * 30]).withColumn("quality", F.lit("q")).withColumn("m", F.lit(1))
    kept = quality.keep_clean(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2]
    assert {r["quality"] for r in kept.collect()} == {"q"}


def test_verdict_goes_beyond_the_base_rules(docs):
    """A short line over and over, too short for windows of 8; and a header that comes twice."""
    words = [f"word{i}" for i in range(80)]
    looped = " ".join(words[:40]) + "".join(f"\nthe same five words here x{i}" for i in range(12))
    stuttering = " ".join(w for w in words[:20] for _ in range(4))
    framed = "\n".join([" ".join(words[:10]), " ".join(words[10:60]), " ".join(words[:10])])
    rows = {r["doc_id"]: r["quality"] for r in quality.repetition(docs([looped, framed, stuttering])).collect()}
    assert not rows[2]["base_failed"] and not rows[2]["kept"]
    assert not rows[0]["base_failed"] and not rows[0]["kept"]
    assert not rows[1]["base_failed"] and rows[1]["kept"]


def test_each_length_alone_decides(docs):
    """Windows of n words that come again, with words between them that don't, so that no longer window repeats."""
    texts = []
    for n, most in LIMITS.items():
        for over in (0, 1):
            times = next(k for k in range(2, 400) if n * (k - 1) / 400 > most) - 1 + over
            fresh = iter(f"x{i:03}" for i in range(400))
            parts = [" ".join(f"r{j:03}" for j in range(n)) + " " + next(fresh) for _ in range(times)]
            words = " ".join(parts).split()
            texts.append(" ".join(words + [next(fresh) for _ in range(400 - len(words))]))
    kept = {r["doc_id"]: r["quality"]["kept"] for r in quality.repetition(docs(texts)).collect()}
    assert [kept[k] for k in range(len(texts))] == [True, False] * len(LIMITS)
    assert [plain(t)[-1] for t in texts] == [True, False] * len(LIMITS)


def test_a_quarter_in_passages_and_a_slogan_are_too_much(docs):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(3, 8)))
    passage, slogan = " ".join(word() for _ in range(14)), " ".join(word() for _ in range(6))
    fill = lambda n: " ".join(word() for _ in range(n))
    texts = [" ".join(f"{passage} {fill(42)}" for _ in range(4)), " ".join(f"{slogan} {fill(11)}" for _ in range(12)), fill(220)]
    assert [r["quality"]["kept"] for r in quality.repetition(docs(texts)).orderBy("doc_id").collect()] == [False, False, True]


def test_empty_table(docs):
    assert quality.keep_clean(docs([])).collect() == []
