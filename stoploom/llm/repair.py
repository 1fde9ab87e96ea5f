"""Repair of conversation structure at the least cost.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles: at most one system row, then user and
assistant in turn. Each row has at most one fault: blank, duplicate of an earlier row, or truncated. Edits, one letter
each: Keep, Rerole to user or assistant, Delete (required for blank and duplicate rows), Insert an empty
row. The repair is the cheapest list of edits; of several, the one whose letters come first in ASCII order.

Both wishes are one number. The weight of a list of edits is its cost in the high digits and, below, its letters in
digits of ``_BITS`` bits at fixed places, the first letter highest, with zeros behind the last one; a list that
is the beginning of another is smaller. Over the graph of (row, inserts before it, state of the pattern) the
least weight is a plain minimum of integers: from the end to the front, an edit in front of a list of edits moves
its letters one place down and adds its own. The letters of the least weight are the audit; roles follow from it.

The job shuffles two things. For the weights only a few bytes a row, with digests instead of texts; a conversation's task
holds two bytes a row and weights of three digits a row, and equal rows arrive as one row with a count, so
a conversation of many copies is small. For the digest of the repaired text, rows in order behind their audit,
one row of text at a time. A conversation is repaired by one task, because each edit depends on all others
and its digest reads its rows in order; the time of its weights grows with the square of its rows (about a second at
10,000 rows).

Defined cases: null role or text count as one blank, a null turn as one blank in the damage's key and before all turns
in order, with no part in gaps; a null conv_id is a conversation of its own. Rows of one turn are in order of role,
then of the text's digest. A conversation without rows has zeros, an empty audit and the digest of nothing. Other
columns are never looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, small_batches

#: What edits cost, and what a truncated row costs that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Digits of letters in ASCII order; zero is no letter.
_LETTERS = "\0DIKR"
_D, _I, _K, _R = range(1, 5)
_BITS = 3
#: States of the pattern: nothing yet, after s, after u, after a. What may follow, and where it may end.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_ENDS = (0, 3)
#: Faults of rows.
FINE, BLANK, DUPLICATE, CUT = range(4)
#: Adjacent initials that are as they should be.
LEGAL = ("su", "ua", "au")
#: ASCII white space, the characters that don't count as text.
_SPACE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Costs:
    keep: int = KEEP
    rerole: int = REROLE
    delete: int = DELETE
    insert: int = INSERT
    truncated: int = TRUNCATED


def cheapest(rows: Iterable[tuple[str, int]], costs: Costs = Costs()) -> tuple[int, str]:  # noqa: B008
    """(cost, audit) of the least repair of rows (initial, fault)."""
    rows = list(rows)
    places = 3 * len(rows) + 2  # at most two inserts before each row and at the end
    top, high = _BITS * (places - 1), _BITS * places
    low = (1 << high) - 1

    def put(edit: int, cost: int, rest: int) -> int:
        """The weight of an edit in front of a list of edits."""
        return (((rest >> high) + cost) << high) | (edit << top) | ((rest & low) >> _BITS)

    def with_inserts(least: list[int | None]) -> list[int | None]:
        """Up to two inserts first: more only come back to a state."""
        for _ in range(2):
            found = list(least)
            for q in range(4):
                for c in "ua":
                    to = _NEXT[q].get(c)
                    if to is not None and least[to] is not None:
                        now = put(_I, costs.insert, least[to])
                        found[q] = now if found[q] is None else min(found[q], now)
            least = found
        return least

    least = with_inserts([0 if q in _ENDS else None for q in range(4)])
    for initial, fault in reversed(rows):
        found: list[int | None] = []
        extra = costs.truncated if fault == CUT else 0
        for q in range(4):
            ways = [] if least[q] is None else [put(_D, costs.delete, least[q])]
            if fault not in (BLANK, DUPLICATE):
                for edit, cost, c in ((_K, costs.keep, initial), (_R, costs.rerole, "u"), (_R, costs.rerole, "a")):
                    to = _NEXT[q].get(c)
                    if to is not None and least[to] is not None:
                        ways.append(put(edit, cost + extra, least[to]))
            found.append(min(ways) if ways else None)
        least = with_inserts(found)
    weight = least[0]
    if weight is None:
        raise ValueError("no edits lead to the pattern")
    letters = weight & low
    audit = []
    for k in range(places):
        letter = (letters >> (_BITS * (places - 1 - k))) & ((1 << _BITS) - 1)
        if not letter:
            break
        audit.append(_LETTERS[letter])
    return weight >> high, "".join(audit)


def repaired(rows: Iterable[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation; ``rows`` are read one at a time."""
    rows, state = iter(rows), 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if "a" in _NEXT[state] else "user"
        state = _NEXT[state][role[:1]]
        yield role, text


# --- damage and faults -------------------------------------------------------------------------


def plain(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text), null role and text as one blank."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return turns.select("conv_id", "turn", *filled)


def damage(turns: DataFrame) -> DataFrame:
    """Rows of ``plain`` after damage: dropped, emptied, unended, repeated or given the role user, as a checksum
    of conversation and turn says."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    made = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.array_repeat(F.lit(0), times).alias("copies"))
    return made.select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


def _end(text: Column) -> Column:
    """The last character that is not white space; empty if there is none."""
    return F.right(F.rtrim(text, F.lit(_SPACE)), F.lit(1))


def _facts(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, initial, blank, cut, mark, n): distinct rows, ``mark`` a digest of role and text."""
    end = _end(F.col("text"))
    mark = F.concat(F.md5("role"), F.md5("text"))
    slim = rows.select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), (end == "").alias("blank"),
        (~end.isin(".", "!", "?")).alias("cut"), "role", mark.alias("mark"),
    )
    return slim.groupBy(*slim.columns).agg(F.count(F.lit(1)).alias("n"))


def _by_conversation(rows: DataFrame, *order: Column | str) -> DataFrame:
    """Rows of a conversation together and in order, null conversations apart from all others."""
    dealt = rows.withColumn("none", F.col("conv_id").isNull()).repartition("none", "conv_id")
    return dealt.sortWithinPartitions("none", "conv_id", *order)


class _Conversation:
    """What is known of a conversation while its rows come by, in order."""

    def __init__(self, key: tuple, costs: Costs):
        self.key, self.costs, self.seen, self.rows = key, costs, set(), []
        self.first = self.last = None
        self.turns = self.illegal = 0
        self.faults = [0, 0, 0, 0]

    def add(self, turn: int | None, initial: str, blank: bool, cut: bool, mark: str, n: int) -> None:
        if turn is not None:
            self.turns += turn != self.last
            self.first = turn if self.first is None else self.first
            self.last = turn
        if self.rows:
            self.illegal += self.rows[-1][0] + initial not in LEGAL
        self.illegal += (n - 1) * (2 * initial not in LEGAL)
        known = bytes.fromhex(mark)
        fault = BLANK if blank else DUPLICATE if known in self.seen else CUT if cut else FINE
        self.seen.add(known)
        again = BLANK if blank else DUPLICATE
        self.faults[fault] += 1
        self.faults[again] += n - 1
        self.rows += [(initial, fault), *[(initial, again)] * (n - 1)]

    def done(self) -> tuple:
        cost, audit = cheapest(self.rows, self.costs)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (*self.key, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], self.illegal, cost, audit)


_FIGURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_NAMES = [c.split()[0] for c in _FIGURES.split(", ")]


def _stream(batches, columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        columns = list(zip(*held, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    weight = 0
    for row in rows:
        held.append(row)
        weight += 64 + sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= size or weight > 1 << 22:
            yield made()
            held, weight = [], 0
    yield made()


def audits(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:  # noqa: B008
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation with rows."""
    facts = _facts(rows)
    kind = facts.schema["conv_id"].dataType.simpleString()
    columns = ["none", "conv_id", "turn", "initial", "blank", "cut", "mark", "n"]

    def run(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return

        def rows():
            now = None
            for none, conv, turn, *facts in _stream((b for part in ([first], batches) for b in part), columns):
                if now is None or now.key != (none, conv):
                    if now is not None:
                        yield now.done()[1:]
                    now = _Conversation((none, conv), costs)
                now.add(turn, *facts)
            if now is not None:
                yield now.done()[1:]

        types = [first.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string()]
        yield from _batches(rows(), ["conv_id", *_NAMES], types)

    ordered = _by_conversation(facts, F.col("turn").asc_nulls_first(), "role", "mark").select(*columns)
    return ordered.mapInArrow(run, f"conv_id {kind}, {_FIGURES}")


def repair(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) of every row of the repaired conversations, from rows and their ``audits``."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _apply(rows, found, f"conv_id {kind}, place long, role string, text string", _repaired_rows)


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): ``role:text`` of the repaired rows, joined by a line feed."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _apply(rows, found, f"conv_id {kind}, repaired_sha256 string", _repaired_digest)


def _repaired_rows(conv, made: Iterator[tuple[str, str]]) -> Iterator[tuple]:
    for place, (role, text) in enumerate(made):
        yield conv, place, role, text


def _repaired_digest(conv, made: Iterator[tuple[str, str]]) -> Iterator[tuple]:
    digest = hashlib.sha256()
    for k, (role, text) in enumerate(made):
        digest.update(("\n" * (k > 0) + f"{role}:{text}").encode())
    yield conv, digest.hexdigest()


def _apply(rows: DataFrame, found: DataFrame, schema: str, made) -> DataFrame:
    """Rows behind their audit, in order, one conversation after another."""
    null = lambda kind: F.lit(None).cast(kind)
    heads = found.select("conv_id", F.lit(0).alias("part"), null(rows.schema["turn"].dataType).alias("turn"), null("string").alias("role"), F.col("audit").alias("text"), null("string").alias("mark"))
    body = rows.select("conv_id", F.lit(1).alias("part"), "turn", "role", "text", F.concat(F.md5("role"), F.md5("text")).alias("mark"))
    both = _by_conversation(heads.union(body), "part", F.col("turn").asc_nulls_first(), "role", "mark")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return

        def out():
            stream = _stream((b for part in ([first], batches) for b in part), ["part", "conv_id", "role", "text"])
            head = next(stream, None)
            while head is not None:
                held: list = [None]

                def body(held=held):
                    for row in stream:
                        if row[0] == 0:
                            held[0] = row
                            return
                        yield row[2:]

                own = body()
                yield from made(head[1], repaired(own, head[3]))
                for _ in own:  # rows behind the last edit: none, but the next head must be reached
                    pass
                head = held[0]

        of = {"long": pa.int64(), "string": pa.string()}
        types = [first.schema.field("conv_id").type, *(of[c.split()[1]] for c in schema.split(", ")[1:])]
        yield from _batches(out(), names, types)

    return both.select("part", "conv_id", "role", "text").mapInArrow(run, schema)


def report(turns: DataFrame, costs: Costs = Costs()) -> DataFrame:  # noqa: B008
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation of
    ``turns`` after ``damage``."""
    small_batches(turns.sparkSession)
    sound = plain(turns)
    rows = damage(sound)
    found = keep(audits(rows, costs), "audits")
    hashed = digests(rows, found)
    every = sound.select("conv_id").distinct()
    both = found.alias("f").join(hashed.alias("h"), F.col("f.conv_id").eqNullSafe(F.col("h.conv_id")))
    both = both.select(F.col("f.conv_id").alias("conv"), *[F.col(f"f.{c}") for c in _NAMES], "repaired_sha256")
    out = every.join(both, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in _NAMES[:-1]]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
