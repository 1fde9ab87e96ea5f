"""SimHash near-duplicates by a generalised pigeonhole search.

Each text has a 64-bit SimHash of its word shingles. Two fingerprints link at ``distance`` or fewer
differing bits; components of links are groups of near copies.

The search: bits that correlate over the corpus are grouped into m parts. If two fingerprints
differ in at most d bits and thresholds T_i (-1 allowed) sum to d - m + 1, then in some part i they
differ in at most T_i bits. Every fingerprint picks its own thresholds: a dynamic program
minimises its probes plus the candidates that histograms of part values promise, so crowded part
values are not probed. A probe is an equi-join on (part, value) that verifies the whole distance.

Groups with very many near copies: all pairs inside one would be links. Fingerprints that share a
neighbour at one flipped bit are linked first (smallest with largest, 65 rows a fingerprint) and
contracted; the search then joins only fingerprints of different classes, which loses no
component and never lists the pairs of a class.

Defined cases: a text without words, null included, has fingerprint zero and links like any other; rows
that repeat a doc_id each get a row; a null doc_id is never a group's smallest unless the group has
no other; other columns are never looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, same, small_batches, text_bytes, unused

BITS = 64
SHINGLE_WORDS = 4
DISTANCE = 4
SEED = 42
#: Shingles hashed at once, which bounds the memory that a long text takes.
_BLOCK = 1 << 15
#: What one probe (a shuffled row) costs, in candidates checked inside the join.
_PROBE_COST = 12.0


def fingerprint(data: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash of whole UTF-8 bytes, as an unsigned 64-bit number."""
    parts = data.lower().split()  # of bytes: lower-cases A-Z only, splits at ASCII white space only
    if not parts:
        return 0
    width = min(words, len(parts))
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[: len(parts) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(first), _BLOCK):
        spans = zip(first[at : at + _BLOCK], last[at : at + _BLOCK], strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint as a signed long with the same bits."""
    small_batches(docs.sparkSession)
    slim = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    schema = slim.select("doc_id", "text_hash").schema.add("fp", "long")

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in text_bytes(batch.column("text"))], dtype=np.uint64)
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "fp"])

    return slim.mapInArrow(run, schema)


# --- parts, histograms, thresholds -------------------------------------------------------------


def _ball(width: int, radius: int) -> int:
    return sum(math.comb(width, k) for k in range(radius + 1)) if radius >= 0 else 0


def part_count(rows: int, distance: int = DISTANCE) -> int:
    """The number of parts with the least probes and candidates if bits were uniform."""

    def cost(m: int) -> float:
        width, budget = BITS / m, distance - m + 1
        best = {0: 0.0}
        for _ in range(m):  # thresholds of -1 .. distance for each part
            step: dict[int, float] = {}
            for s, c in best.items():
                for t in range(-1, distance + 1):
                    balls = _ball(round(width), t)
                    now = c + balls * (_PROBE_COST + rows / 2**width)
                    step[s + t] = min(step.get(s + t, math.inf), now)
            best = step
        return best[budget] + m * _PROBE_COST

    return min(range(2, distance + 2), key=cost)


def correlated_parts(ones: np.ndarray, rows: int, m: int) -> list[list[int]]:
    """Groups of bits, each started by the bit left and filled with those most correlated to it.

    ``ones[i, j]``: rows with bits i and j both set."""
    rows = max(rows, 1)
    p = np.diag(ones) / rows
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    close = np.abs(ones / rows - np.outer(p, p)) / np.outer(spread, spread)
    left, parts = set(range(BITS)), []
    for k in range(m):
        width = BITS // m + (k < BITS % m)
        group = [max(left, key=lambda b: (close[b, sorted(left)].sum(), -b))]
        left.discard(group[0])
        while len(group) < width:
            near = max(left, key=lambda b: (close[b, group].sum(), -b))
            group.append(near)
            left.discard(near)
        parts.append(sorted(group))
    return parts


def _blocks(part: list[int]) -> list[list[int]]:
    """A part in pieces of at most 16 bits, whose histograms have a fixed size."""
    n = -(-len(part) // 16)
    return [part[i::n] for i in range(n)]


def _gather(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), dtype=np.int64)
    for k, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return out


def _at_distance(counts: np.ndarray, width: int, distance: int) -> np.ndarray:
    """[d, v]: rows whose value differs from v in exactly d of ``width`` bits."""
    out = np.zeros((distance + 1, len(counts)))
    out[0] = counts
    every = np.arange(len(counts))
    for b in range(width):
        flipped = out[:, every ^ (1 << b)]
        out[1:] += flipped[:-1]
    return out


class Search:
    """Parts with their histograms; chooses thresholds and makes probes. Its size is fixed."""

    def __init__(self, parts: list[list[int]], counts: dict[tuple[int, int], np.ndarray], rows: int, distance: int):
        self.parts, self.rows, self.distance = parts, rows, distance
        self.near = {
            k: _at_distance(c, len(_blocks(parts[k[0]])[k[1]]), distance).astype(np.float32) for k, c in counts.items()
        }
        self._masks: dict[tuple[int, int], np.ndarray] = {}

    def masks(self, width: int, radius: int) -> np.ndarray:
        """All values of ``width`` bits with at most ``radius`` bits set."""
        if (width, radius) not in self._masks:
            found = [sum(1 << b for b in on) for r in range(radius + 1) for on in itertools.combinations(range(width), r)]
            self._masks[width, radius] = np.array(found, dtype=np.int64)
        return self._masks[width, radius]

    def candidates(self, fps: np.ndarray, part: int) -> np.ndarray:
        """[t, row]: estimated rows within t bits of each fingerprint's part; pieces count as independent."""
        total = None
        for k, bits in enumerate(_blocks(self.parts[part])):
            own = self.near[part, k][:, _gather(fps, bits)]
            if total is None:
                total = own
            else:
                share = own / max(self.rows, 1)
                total = np.stack([sum(total[i] * share[d - i] for i in range(d + 1)) for d in range(self.distance + 1)])
        return np.cumsum(total, axis=0)

    def thresholds(self, fps: np.ndarray) -> np.ndarray:
        """[part, row]: thresholds that sum to distance - m + 1 at the least estimated cost."""
        m, d = len(self.parts), self.distance
        sums = range(-m, d + 1)
        best = {0: np.zeros(len(fps))}
        took: list[dict[int, np.ndarray]] = []
        for k, part in enumerate(self.parts):
            seen = self.candidates(fps, k)
            price = {t: _PROBE_COST * _ball(len(part), t) + (seen[t] if t >= 0 else 0) for t in range(-1, d + 1)}
            step, choice = {}, {}
            for s in sums:
                for t in range(-1, d + 1):
                    if s - t in best:
                        now = best[s - t] + price[t]
                        if s not in step:
                            step[s], choice[s] = now, np.full(len(fps), t)
                        else:
                            less = now < step[s]
                            step[s] = np.where(less, now, step[s])
                            choice[s][less] = t
            best = step
            took.append(choice)
        out = np.zeros((m, len(fps)), dtype=np.int64)
        left = np.full(len(fps), d - m + 1)
        for k in reversed(range(m)):
            for s in sums:
                at = left == s
                if s in took[k] and at.any():
                    out[k, at] = took[k][s][at]
            left = left - out[k]
        return out

    def keys(self, fps: np.ndarray, probe: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, keys) of each part: own value, or all values within the row's threshold."""
        chosen = self.thresholds(fps) if probe else None
        for k, part in enumerate(self.parts):
            value = _gather(fps, part) | (k << 40)
            if not probe:
                yield np.arange(len(fps)), value
                continue
            for t in np.unique(chosen[k]):
                if t < 0:
                    continue
                rows = np.flatnonzero(chosen[k] == t)
                flips = self.masks(len(part), int(t))
                yield np.repeat(rows, len(flips)), (value[rows][:, None] ^ flips[None, :]).ravel()


def plan_search(fps: DataFrame, distance: int = DISTANCE) -> Search:
    """Reads bit correlations, then part histograms, of all fingerprints. The driver gets 64 x 64
    counts and at most 65,536 counts a piece, however many rows there are."""

    def pairs(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            own = np.asarray(batch.column(0)).view(np.uint8)
            bits = np.unpackbits(own, bitorder="little").reshape(-1, BITS).astype(np.float32)
            total, n = total + (bits.T @ bits).astype(np.float64), n + len(bits)
        flat = np.append(total.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["at", "n"])

    seen = fps.mapInArrow(pairs, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for row in seen:
        flat[row["at"]] = row["n"]
    rows = int(flat[-1])
    parts = correlated_parts(flat[:-1].reshape(BITS, BITS), rows, part_count(rows, distance))
    pieces = [(k, j, bits) for k, part in enumerate(parts) for j, bits in enumerate(_blocks(part))]

    def values(batches):
        for batch in batches:
            own = np.asarray(batch.column(0)).view(np.uint64)
            for i, (_, _, bits) in enumerate(pieces):
                v, n = np.unique(_gather(own, bits), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(v + (i << 16)), pa.array(n)], names=["at", "n"])

    found = fps.mapInArrow(values, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()
    counts = {(k, j): np.zeros(1 << len(bits)) for k, j, bits in pieces}
    for row in found:
        k, j, _ = pieces[row["at"] >> 16]
        counts[k, j][row["at"] & 0xFFFF] = row["n"]
    return Search(parts, counts, rows, distance)


# --- links and components ----------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b: longs), one root for each component.

    Rounds of contraction: every node takes the smallest name within two links, in an order that
    changes with the round (names xor a constant), and links are renamed. Nothing but a count
    reaches the driver; each round's tables are written to shared storage."""
    both = links.where("a != b").select("a", "b").union(links.where("a != b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = keep(both.distinct(), "links")
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        salt = F.lit(int(np.uint64(xxhash.xxh64_intdigest(b"round", len(maps))).astype(np.int64)))
        name = lambda c: F.col(c).bitwiseXOR(salt)  # noqa: B023, E731
        one = edges.groupBy("a").agg(F.min(name("b")).alias("least")).select("a", F.least("least", name("a")).alias("least"))
        near = edges.join(one.select(F.col("a").alias("b"), "least"), "b").groupBy("a").agg(F.min("least").alias("far"))
        two = near.join(one, "a").select(F.col("a").alias("node"), F.least("far", "least").bitwiseXOR(salt).alias("root"))
        two = keep(two, "roots")
        maps.append(two)
        left = edges.join(two.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
        done = left.join(two.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
        edges = keep(done.where("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "links")
    if not maps:
        return links.sparkSession.createDataFrame([], "node bigint, root bigint")
    out = maps[-1]
    for earlier in reversed(maps[:-1]):
        later = out.select(F.col("node").alias("root"), F.col("root").alias("end"))
        out = earlier.join(later, "root", "left").select("node", F.coalesce("end", "root").alias("root"))
    return out


def neighbour_links(fps: DataFrame) -> DataFrame:
    """Links of the smallest with the largest fingerprint around each point at most one bit away."""
    flips = np.array([0, *(1 << b for b in range(BITS))], dtype=np.uint64)

    def run(batches):
        for batch in batches:
            own = np.asarray(batch.column(0)).view(np.uint64)
            for at in range(0, len(own), 4096):
                some = own[at : at + 4096]
                points = (some[:, None] ^ flips[None, :]).ravel().view(np.int64)
                fps = np.repeat(some, len(flips)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(points), pa.array(fps)], names=["point", "fp"])

    # 65 rows a fingerprint: dealt to all tasks first, as the few files they come from would be few tasks
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    around = fps.repartition(tasks, "fp").mapInArrow(run, "point bigint, fp bigint").groupBy("point")
    return around.agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a < b").select("a", "b").distinct()


def probe_links(classes: DataFrame, search: Search) -> DataFrame:
    """Links (a, b: roots) between different classes of ``classes`` (fp, root)."""

    def keyed(probe: bool):
        def run(batches):
            for batch in batches:
                fps, roots = (np.asarray(batch.column(c)) for c in ("fp", "root"))
                for rows, keys in search.keys(fps.view(np.uint64), probe):
                    for at in range(0, len(rows), 1 << 18):
                        some = rows[at : at + (1 << 18)]
                        columns = [pa.array(keys[at : at + (1 << 18)]), pa.array(fps[some]), pa.array(roots[some])]
                        yield pa.RecordBatch.from_arrays(columns, names=["key", "fp", "root"])

        return classes.select("fp", "root").mapInArrow(run, "key bigint, fp bigint, root bigint")

    p, x = keyed(True).alias("p"), keyed(False).alias("x")
    close = F.bit_count(F.col("p.fp").bitwiseXOR(F.col("x.fp"))) <= search.distance
    found = p.join(x, (F.col("p.key") == F.col("x.key")) & close & (F.col("p.root") != F.col("x.root")))
    return found.select(F.least("p.root", "x.root").alias("a"), F.greatest("p.root", "x.root").alias("b")).distinct()


def _grouped(docs: DataFrame, words: int, distance: int) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row; root is the group's own key."""
    prints = keep(fingerprints(docs, words), "prints")
    fps = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fps")
    search = plan_search(fps.select("fp"), distance)
    first = components(neighbour_links(fps.select("fp")))
    classes = fps.select("fp").join(first.withColumnRenamed("node", "fp"), "fp", "left")
    classes = keep(classes.select("fp", F.coalesce("root", "fp").alias("root")), "classes")
    second = components(probe_links(classes, search)).select(F.col("node").alias("root"), F.col("root").alias("end"))
    groups = classes.join(second, "root", "left").select("fp", F.coalesce("end", "root").alias("root"))
    named = keep(fps.join(groups, "fp"), "groups")
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return prints.join(named.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id is the smallest doc_id reachable."""
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return _grouped(docs, words, distance).select("doc_id", digits, "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """Exactly one row of each group, with all its columns: the smallest doc_id (null after all others),
    then the smallest hash of the text, then the smallest other columns as text.

    Only rows that repeat the first row's doc_id and text are compared by their other columns, in an
    aggregation that reduces them before the exchange."""
    found = _grouped(docs, words, distance).groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "n")).alias("x")
    one, text, many, row = unused(docs, "id", "hash", "rows", "row")
    first = found.groupBy("root").agg(least).select(F.col("x.doc_id").alias(one), F.col("x.text_hash").alias(text), F.col("x.n").alias(many))
    first = keep(first, "first")
    match = same(docs["doc_id"], F.col(one)) & (F.xxhash64(docs["text"]) == F.col(text))
    once = docs.join(first.where(F.col(many) == 1), match, "left_semi")
    names = [F.col(f"`{c}`") for c in docs.columns]
    order = F.struct(F.lit("").alias("none"), *[F.col(f"`{c}`").cast("string") for c in docs.columns if c not in ("doc_id", "text")])
    tied = docs.join(first.where(F.col(many) > 1), match).groupBy(one, text).agg(F.min_by(F.struct(*names), order).alias(row))
    return once.union(tied.select(f"{row}.*"))
