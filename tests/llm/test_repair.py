"""Repairs against a search over all lists of edits, and the whole query against plain Python and SQL."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.compare import differences
from stoploom.llm import repair
from stoploom.llm.oracle import ORACLE
from stoploom.llm.queries import QUERIES
from stoploom.llm.repair import BLANK, CUT, DUPLICATE, Costs

TURNS = "conv_id long, turn long, role string, text string"


def search(rows, costs):
    """The least (cost, audit) of all lists of edits whose result fits, inserts at every place."""
    best = None
    options = []
    for initial, fault in rows:
        extra = costs.truncated if fault == CUT else 0
        own = [("D", costs.delete, "")]
        if fault not in (BLANK, DUPLICATE):
            own += [("K", costs.keep + extra, initial), ("R", costs.rerole + extra, "u"), ("R", costs.rerole + extra, "a")]
        options.append(own)
    fill = [("", 0, ""), *[("I" * n, n * costs.insert, "".join(x)) for n in (1, 2) for x in itertools.product("ua", repeat=n)]]
    steps = [fill, *itertools.chain.from_iterable((o, fill) for o in options)]
    for edits in itertools.product(*steps):
        if re.fullmatch("(s?(ua)+)?", "".join(e[2] or "" for e in edits)):
            now = (sum(e[1] for e in edits), "".join(e[0] for e in edits))
            best = now if best is None or now < best else best
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suat"), st.integers(0, 3)), max_size=3), st.tuples(*[st.integers(0, 3)] * 2, st.integers(1, 4), st.integers(1, 3), st.integers(0, 6)))
def test_least_edits_of_all_with_other_costs(rows, costs):
    costs = Costs(*costs)
    assert repair.cheapest(rows, costs) == search(rows, costs)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suat"), st.integers(0, 3)), max_size=3))
def test_least_edits_of_all(rows):
    assert repair.cheapest(rows) == search(rows, Costs())


def dynamic(rows):
    """The same for long conversations: suffixes as (cost, audit), without inserts, which never pay."""
    nexts = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
    least = [(0, ""), None, None, (0, "")]
    for initial, fault in reversed(rows):
        new = []
        for q in range(4):
            ways = [(least[q], 2, "D")]
            if fault not in (BLANK, DUPLICATE):
                extra = 5 * (fault == CUT)
                ways += [(least[nexts[q][c]], cost + extra, e) for e, cost, c in (("K", 0, initial), ("R", 1, "u"), ("R", 1, "a")) if c in nexts[q]]
            new.append(min(((v[0] + c, e + v[1]) for v, c, e in ways if v is not None), default=None))
        least = new
    return least[0]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suuaaat"), st.sampled_from([0, 0, 0, 1, 2, 3])), max_size=60))
def test_long_conversations(rows):
    assert repair.cheapest(rows) == dynamic(rows)


def plain(turns):
    """The whole report of the query, row by row."""
    conversations = defaultdict(list)
    for conv, turn, role, text in turns:
        own = conversations[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    for conv, rows in conversations.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), md5(r[1]) + md5(r[2])))
        seen, facts = set(), []
        for _, role, text in rows:
            end = re.sub("[\x20\x09-\x0d]+$", "", text)[-1:]
            facts.append((role[:1], BLANK if not end else DUPLICATE if (role, text) in seen else CUT if end not in ".!?" else 0))
            seen.add((role, text))
        known = [t for t, _, _ in rows if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(facts))
        cost, audit = dynamic(facts)
        kept, roles = [], {"u": "user", "a": "assistant"}
        for edit, (_, role, text) in zip(audit, rows, strict=True):
            if edit != "D":
                now = role if edit == "K" else roles["a" if kept and kept[-1][0][:1] == "u" else "u"]
                kept.append((now, text))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        counts = [sum(f == k for _, f in facts) for k in (BLANK, DUPLICATE, CUT)]
        out[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def sample():
    words = ["Yes.", "No!", "Really?", "cut off", "", " \t\n", None, "Fine.  \n", "Wait. what", "é。", "One. Two. Three."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    rows = []
    for conv in range(60):
        for turn in range(conv % 9):
            k = zlib.crc32(f"{conv}/{turn}".encode())
            role = roles[turn % 2] if k % 4 else roles[k // 7 % len(roles)]
            rows.append((conv, None if k % 31 == 0 else turn + (k % 13 == 0), role, words[k // 11 % len(words)]))
    rows += [(None, 0, "user", "Null id."), (None, None, "assistant", "Yes."), (7, 1, "user", "Same turn."), (7, 1, "user", "Same turn."), (7, 1, "assistant", "Same turn too.")]
    rows += [(100, t, ("user", "assistant")[t % 2], "Again.") for t in range(300)]  # copies
    rows += [(101, t, ("user", "assistant")[(t + t // 90) % 2], f"Row {t}" + "." * (t % 17 > 0)) for t in range(700)]
    return rows


def test_query_equals_plain_repairs_and_sql(spark, tables):
    path = tables(conversations=spark.createDataFrame(sample(), TURNS).repartition(4))
    query = QUERIES["op13_conversation_repair"]
    assert {r["conv_id"]: tuple(r)[1:] for r in query(spark, path).collect()} == plain(sample())
    assert differences(query(spark, path), path, ORACLE["op13_conversation_repair"]) is None


def test_dropped_conversations_stay_in_the_report(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repair.report(spark.createDataFrame([(gone, 0, "user", "Hi.")], TURNS)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_rows(spark):
    rows = spark.createDataFrame([(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "assistant", "Bye."), (1, 3, "user", "left out"), (2, 0, "user", "Only.")], TURNS)
    found = repair.audits(rows).collect()
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in found} == {1: (3, "KRKD"), 2: (2, "D")}
    made = repair.repair(rows, repair.audits(rows)).collect()
    assert sorted(map(tuple, made)) == [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Bye.")]


def test_inserts_where_they_are_cheap(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Still there?")], TURNS)
    found = repair.audits(rows, Costs(rerole=9, delete=9, insert=1))
    assert found.first()["audit"] == "KIKI"
    made = repair.repair(rows, found).collect()
    assert sorted((r["place"], r["role"], r["text"]) for r in made) == [(0, "user", "Hi."), (1, "assistant", ""), (2, "user", "Still there?"), (3, "assistant", "")]


@pytest.mark.parametrize("partitions", [1, 5])
def test_clashing_columns_and_partitions(spark, partitions):
    df = spark.createDataFrame(sample(), TURNS).repartition(partitions)
    for name in ("part", "none", "mark", "n", "copies", "audit", "initial", "blank", "cut", "conv"):
        df = df.withColumn(name, F.lit("x"))
    assert {r["conv_id"]: tuple(r)[1:] for r in repair.report(df).collect()} == plain(sample())


def test_empty_table(spark):
    assert repair.report(spark.createDataFrame([], TURNS)).collect() == []
