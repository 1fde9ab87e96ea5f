"""Windows read back against the turns they were made of."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from stoploom.llm import chat
from stoploom.llm.queries import QUERIES

KIND = "conv_id long, turn long, role string, text string"
OWN = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def sample(seed=3):
    rng = random.Random(seed)
    marks = [*chat.CONTROLS, "<\\s>", "[\\\\/INST]", "<", "[", "\\", "</", "[INST", "é𝔘", "\n", "<<\\SYS>>", "s>"]
    text = lambda: " ".join(rng.choice(marks) if rng.random() < 0.3 else "w" * rng.randint(1, 5) for _ in range(rng.choice([0, 3, 40, 300])))
    rows = []
    for c in range(40):
        n = rng.choice([1, 2, 5, 8, 60])
        for t in range(n):
            role = "system" if t == 0 and rng.random() < 0.5 else rng.choice(["user", "assistant", "assistant", "tool", "system", "a[INST]b", None])
            rows.append((c, t, role, None if rng.random() < 0.05 else text()))
    rows += [(50, 0, "assistant", "x " * 30_000), (51, 1, "assistant", "same"), (51, 1, "assistant", "same"), (51, None, "user", "first"), (None, 0, "assistant", "no id")]
    rng.shuffle(rows)
    return rows


def plain(rows):
    out, by = {}, {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, role, text))
    key = lambda x: [(v is not None, v if v is not None else 0) for v in x]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv, turns in by.items():
        turns = [(r or "", t or "") for _, r, t in sorted(turns, key=key)]
        learned = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned))
    return out


def test_read_back_equals_the_turns(spark, tables):
    rows = sample()
    where = tables(conversations=spark.createDataFrame(rows, KIND).withColumn("window", F.lit("x")))
    got = {r["conv_id"]: tuple(r)[1:5] for r in QUERIES["op8_chat_formatting"](spark, where).collect()}
    assert got == plain(rows + OWN)


@pytest.mark.parametrize("limits", [(512, 2, 128), (20, 0, 0), (60, 5, 30), (10**6, 2, 10**6)])
def test_windows_hold_their_budget_and_repeat_what_they_should(spark, limits):
    budget, turns, history = limits
    rows = sample(7)
    made = chat.windows(spark.createDataFrame(rows, KIND).repartition(3), budget, turns, history)
    by = {}
    for r in made.collect():
        by.setdefault(r["conv_id"], []).append(r)
    for conv, found in by.items():
        found.sort(key=lambda r: r["window"])
        assert [r["window"] for r in found] == list(range(len(found)))
        past = []
        for r in found:
            parts = [(chat.unescape(m[1]), chat.unescape(m[2])) for m in chat._TURN.finditer(r["text"])]
            assert "".join(chat.turn_text(*p)[0] for p in parts) == r["text"]
            old, new = parts[: r["n_repeated"]], parts[r["n_repeated"] :]
            system = past[:1] if past and past[0][0] == "system" else []
            assert old[: len(system)] == system and new
            recent = old[len(system) :]
            assert len(recent) <= turns and sum(chat.tokens(t) for _, t in recent) <= history
            assert not recent or recent == past[-len(recent) :]
            assert len(new) == 1 or sum(chat.tokens(t) for _, t in parts) <= budget
            spans = [chat.unescape(r["text"][s["start"] : s["start"] + s["size"]]) for s in r["loss"]]
            assert spans == [t for role, t in new if role == "assistant"]
            past += new
    back = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(made.repartition(5)).collect()}
    assert back == plain(rows)


def test_escapes_are_reversible_and_leave_no_control_string():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choices(["<", "s>", "/", "\\", "[", "INST]", "<SYS>>", "]", "a", ">"], k=rng.randint(0, 12)))
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in chat.CONTROLS)


def test_empty_table(spark):
    assert chat.read_back(chat.windows(spark.createDataFrame([], KIND))).collect() == []
