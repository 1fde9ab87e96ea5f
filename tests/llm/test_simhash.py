"""SimHash groups against all pairs on small inputs."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from stoploom.llm import simhash
from stoploom.llm.queries import QUERIES

QUERY = QUERIES["op1_simhash_near_dedup"]


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, distance=4):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), doc) if x is not None), default=None)
    return sorted(((d, f"{p:016x}", least[find(i)]) for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True))), key=str)


def near_texts(n, copies, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n):
        base = rng.choices(words, k=rng.choice([3, 8, 60, 300]))
        for _ in range(rng.randint(1, copies)):
            text = base.copy()
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice(words)
            out.append(" ".join(text))
    rng.shuffle(out)
    return out


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_groups_equal_all_pairs(spark, docs, tables):
    texts = near_texts(60, 12) + [None, "", " \n\t", "One Two", "one two", "ÄB cd", "äb cd", "x" * 300_000, "a b " * 40_000]
    rows = list(enumerate(texts))
    assert found(QUERY(spark, tables(documents=docs(texts)))) == plain_groups(rows)


def test_repeated_rows_null_ids_and_other_columns(docs):
    texts = [(None, "p q r s t", "a"), (7, "p q r s t", "a"), (7, "p q r s t", "b"), (None, "alone here", None), (3, "other words", "a")]
    df = docs(texts).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("x")).withColumn("root", F.lit(None))
    assert found(simhash.near_groups(df)) == plain_groups([(i, t) for i, t, _ in texts])
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], r["source"]) for r in kept.collect() if r["doc_id"]) == [(3, "a"), (7, "a")]
    assert [r["text"] for r in kept.collect() if r["doc_id"] is None] == ["alone here"]


def test_empty_table(docs):
    assert simhash.near_groups(docs([])).collect() == []
    assert simhash.keep_one(docs([])).collect() == []


def test_links_at_every_distance_are_found(spark):
    """Fingerprints up to 4 bits apart are linked by the search alone, in crowded parts too."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, size=40, dtype=np.int64).view(np.uint64)
    crowd = base[0] ^ (np.uint64(1) << rng.integers(0, 64, size=200).astype(np.uint64))
    far = [int(b) ^ sum(1 << int(x) for x in rng.choice(64, size=k, replace=False)) for b in base for k in (1, 2, 3, 4, 5, 6)]
    fps = sorted({int(x) for x in base} | {int(x) for x in crowd} | set(far))
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    df = spark.createDataFrame([(x, x) for x in signed], "fp long, root long")
    search = simhash.plan_search(df.select("fp"))
    assert sorted(b for p in search.parts for b in p) == list(range(64))
    chosen = search.thresholds(np.array(fps, dtype=np.uint64))
    assert (chosen.sum(axis=0) == 4 - len(search.parts) + 1).all()
    got = {tuple(sorted((r["a"], r["b"]))) for r in simhash.probe_links(df, search).collect()}
    want = {tuple(sorted((signed[i], signed[j]))) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4}
    assert got == want


def test_more_rows_take_fewer_wider_parts():
    counts = [simhash.part_count(10**k) for k in (3, 6, 9, 12)]
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[-1]


def test_components_of_paths_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(300 + i, 300 + (i + 1) % 9) for i in range(9)] + [(7, 7)]
    out = simhash.components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = {}
    for r in out:
        groups.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(sorted, groups.values())) == [list(range(61)), list(range(100, 180)), list(range(300, 309))]
    assert len(out) == 61 + 80 + 9
