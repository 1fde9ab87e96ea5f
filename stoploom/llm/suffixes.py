"""Removal of repeated passages: every byte of a string of ``length`` bytes that also starts elsewhere.

A suffix array of the corpus, built one bucket at a time:

1. Buckets. A suffix belongs to the bucket of the smallest (by hash) of the ``ANCHOR``-byte strings
   within its first ``length`` bytes, at its distance from that anchor. Suffixes that share
   ``length`` bytes share both, so buckets can be sorted apart. Consecutive suffixes of one bucket
   form a run; runs, not suffixes, are shuffled, each as a digest of the text it covers.
2. Runs with equal digests are equal strings: all their suffixes repeat. One of them stands for its
   class. Buckets with a single class need no sorting.
3. The classes of a bucket are sorted in one task with a difference cover of period ``PERIOD``: the
   suffixes at cover positions are ranked first, by doubling; any suffix is then ordered by its
   first ``PERIOD`` bytes and, on a tie, by the rank of the next cover position, however long the tie is.
   Neighbours in that order whose ``length`` first bytes are equal repeat.
4. Buckets of more than ``BUCKET_RUNS`` classes, which one task should not sort, count their
   suffixes by 128-bit digests in a distributed aggregation instead; the result is the same.

Anchors lie at residue 0 of the period, so suffixes at one distance from their anchors compare their
cover ranks at one offset.

Memory in a task: one text, or the runs of one batch of buckets (at most ``BATCH_BYTES`` of text and
one bucket). Texts cross one exchange, compressed.

Defined cases: a null text counts as empty; texts shorter than ``length`` keep all bytes; rows that repeat
doc_id and text count as two places, so both lose what they share; doc_id may be null. Matches
never cross documents. Other columns pass through ``strip`` untouched.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, small_batches, small_reads, text_bytes, unused

LENGTH = 400
#: Bytes of an anchor for the default length; shorter lengths have anchors in proportion, at least 8 bytes.
ANCHOR = 64
PERIOD = 64
BUCKET_RUNS = 2048
BATCH_BYTES = 1 << 20
#: Runs that leave a task in one Arrow batch.
RUN_ROWS = 1 << 14
#: Suffixes looked at together; texts longer than that are worked off in pieces.
_PIECE = 1 << 17
_LOCAL = np.uint64((1 << 18) - 1)


# --- hashing windows of bytes ------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


class Windows:
    """Hashes of all windows of ``width`` bytes: sums of byte numbers times powers, mod 2^64."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, width: int, most: int):
        self.width = width
        self.up = _powers(self.BASE, most + 1)
        self.down = _powers(pow(self.BASE, -1, 1 << 64), most + 1)
        self.byte = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(self.BASE))

    def hashes(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.byte[data] * self.up[: len(data)], out=sums[1:])
        n = len(data) - self.width + 1
        return _mix((sums[self.width :] - sums[:n]) * self.down[:n])


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchor_of(length: int) -> int:
    return min(ANCHOR, max(8, ANCHOR * length // LENGTH))


def text_runs(data: bytes, length: int, windows: Windows) -> list[tuple[int, int, int, int, bytes]]:
    """(start, suffixes, anchor - start, bucket, digest) of each run of a text."""
    whole = np.frombuffer(data, dtype=np.uint8)
    span = length - windows.width + 1
    out = []
    for at in range(0, len(data) - length + 1, _PIECE):
        piece = whole[at : at + _PIECE + length - 1]
        hashes = windows.hashes(piece)
        least = _sliding_min((hashes & ~_LOCAL) | np.arange(len(hashes), dtype=np.uint64), span)
        starts = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
        sizes = np.diff(np.append(starts, len(least)))
        anchors = (least[starts] & _LOCAL).astype(np.int64)
        buckets = hashes[anchors].view(np.int64)
        for s, n, a, b in zip(starts.tolist(), sizes.tolist(), anchors.tolist(), buckets.tolist(), strict=True):
            digest = hashlib.blake2b(data[at + s : at + s + n + length - 1], digest_size=16).digest()
            out.append((at + s, n, a - s, b, digest))
    return out


# --- sorting a bucket --------------------------------------------------------------------------


def cover(period: int) -> np.ndarray:
    """A difference cover: every difference mod ``period`` occurs between two of its members."""
    root = int(np.ceil(np.sqrt(period)))
    return np.unique(np.concatenate((np.arange(root), np.arange(0, period, root))) % period)


def _rank(*keys: np.ndarray) -> np.ndarray:
    """Ranks of rows ordered by ``keys``, equal rows alike."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    for k in keys:
        ranked = k[order]
        new[1:] |= ranked[1:] != ranked[:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def repeated_suffixes(texts: list[bytes], sizes: list[int], anchors: list[int], buckets: np.ndarray, length: int) -> list[np.ndarray]:
    """For each run's text, which of its ``sizes`` suffixes share ``length`` bytes with another's.

    Runs are of whole buckets; ``buckets`` numbers them."""
    period, members = PERIOD, cover(PERIOD)
    # one text, every anchor at residue 0
    places, total = [], 0
    for text, a in zip(texts, anchors, strict=True):
        total += -(total + a) % period
        places.append(total)
        total += len(text)
    reach = 2 * length + 4 * period  # beyond the last suffix, for ranks
    flat = np.zeros(total + reach + period, dtype=np.uint8)
    for p, text in zip(places, texts, strict=True):
        flat[p : p + len(text)] = np.frombuffer(text, dtype=np.uint8)
    sizes_, places_, anchors_ = np.array(sizes), np.array(places), np.array(anchors)
    run = np.repeat(np.arange(len(texts)), sizes_)
    inside = np.arange(len(run)) - np.repeat(np.cumsum(sizes_) - sizes_, sizes_)
    start = places_[run] + inside
    ahead = anchors_[run] - inside  # distance to the anchor
    # a suffix alone at its distance in its bucket can't repeat
    group = _rank(buckets[run], ahead)
    some = np.bincount(group)[group] > 1
    flags = np.zeros(len(run), dtype=bool)
    if some.any():
        at, group = start[some], group[some]
        words = np.lib.stride_tricks.sliding_window_view(flat, 8)

        def prefix_rank(of: np.ndarray) -> np.ndarray:
            keys = [np.ascontiguousarray(words[of + k]).view(">u8").ravel() for k in range(0, period, 8)]
            return _rank(*keys)

        # ranks at cover positions, by doubling from ``period`` bytes to more than ``length``
        lattice = (np.arange(0, total + reach - period, period)[:, None] + members[None, :]).ravel()
        grid = prefix_rank(lattice).reshape(-1, len(members))
        depth = period
        while depth < length + period:
            step = depth // period
            later = np.full_like(grid, -1)
            later[:-step] = grid[step:]
            grid = _rank(grid.ravel(), later.ravel()).reshape(grid.shape)
            depth *= 2
        column = np.full(period, -1)
        column[members] = np.arange(len(members))
        # the next cover position at or after each residue
        next_at = np.array([next(d for d in range(period) if column[(r + d) % period] >= 0) for r in range(period)])
        sample = at + next_at[at % period]
        ranks = grid[sample // period, column[sample % period]]
        order = np.lexsort((ranks, prefix_rank(at), group))
        ranked, by = at[order], group[order]
        same = np.zeros(len(order), dtype=bool)  # as the one before it
        pairs = np.flatnonzero(by[1:] == by[:-1])
        rows = np.lib.stride_tricks.sliding_window_view(flat, length)
        for k in range(0, len(pairs), 1 << 14):
            p = pairs[k : k + (1 << 14)]
            same[p + 1] = (rows[ranked[p]] == rows[ranked[p + 1]]).all(axis=1)
        hit = same.copy()
        hit[:-1] |= same[1:]
        found = np.zeros(len(at), dtype=bool)
        found[order] = hit
        flags[some] = found
    return np.split(flags, np.cumsum(sizes_)[:-1])


def _stretches(flags: np.ndarray) -> list[tuple[int, int]]:
    """(start, size) of each stretch of set flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


# --- the job -----------------------------------------------------------------------------------

_KEYS = ["id_hash", "text_hash"]


def _packed(docs: DataFrame, side: list[str]) -> DataFrame:
    """(side, id_hash, text_hash, n_bytes, data): texts compressed, dealt by their keys."""
    side_column = F.struct(*[F.col(f"`{c}`") for c in side]).alias("side")
    slim = docs.select(side_column, F.xxhash64("doc_id").alias("id_hash"), F.xxhash64("text").alias("text_hash"), "text")
    schema = slim.drop("text").schema.add("n_bytes", "long").add("data", "binary")

    def run(batches):
        for batch in batches:
            texts = list(text_bytes(batch.column("text")))
            sizes = pa.array([len(t) for t in texts], pa.int64())
            data = pa.array([pa.compress(t, codec="zstd", asbytes=True) if t else b"" for t in texts], pa.binary())
            columns = [batch.column(c) for c in ("side", *_KEYS)]
            yield pa.RecordBatch.from_arrays([*columns, sizes, data], names=schema.names)

    return slim.mapInArrow(run, schema).repartition(*_KEYS)


def _raw(data: bytes, n: int) -> bytes:
    return pa.decompress(data, decompressed_size=n, codec="zstd", asbytes=True) if n else b""


def find_runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row for each run of suffixes of a bucket, see ``text_runs``."""
    slim = docs.select(F.xxhash64("doc_id").alias("id_hash"), F.xxhash64("text").alias("text_hash"), "text")
    names = [*_KEYS, "start", "size", "ahead", "bucket", "d1", "d2"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        windows = Windows(anchor_of(length), _PIECE + length)
        for batch in batches:
            ids, hashes = batch.column("id_hash").to_pylist(), batch.column("text_hash").to_pylist()
            columns = [[] for _ in names]
            for i, h, text in zip(ids, hashes, text_bytes(batch.column("text")), strict=True):
                if len(text) < length:
                    continue
                for s, n, a, b, digest in text_runs(text, length, windows):
                    row = (i, h, s, n, a, b, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True))
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                if len(columns[0]) > RUN_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
                    columns = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return slim.mapInArrow(run, "id_hash long, text_hash long, start long, size int, ahead int, bucket long, d1 long, d2 long")


def _matters(runs: DataFrame) -> DataFrame:
    """Runs that repeat as a whole (``whole``), and one of each class that must be sorted (``rivals`` > 1
    classes in its bucket)."""
    place = F.xxhash64(*_KEYS, "start")
    classes = runs.groupBy("bucket", "d1", "d2").agg(F.count("*").alias("n"), F.min(place).alias("place"))
    rivals = classes.groupBy("bucket").agg(F.count("*").alias("rivals")).where("rivals > 1")
    known = classes.join(rivals, "bucket", "left").where("n > 1 OR rivals > 1")
    found = runs.join(known, ["bucket", "d1", "d2"])
    stands = F.col("rivals").isNotNull() & (place == F.col("place"))
    found = found.withColumn("rivals", F.when(stands, F.col("rivals"))).withColumn("whole", F.col("n") > 1)
    return found.where("whole OR rivals IS NOT NULL").select(*_KEYS, "start", "size", "ahead", "bucket", "rivals", "whole")


def _run_texts(packed: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """``runs`` with their texts, cut from the documents they stand in."""
    wanted = runs.groupBy(*_KEYS).agg(F.collect_set(F.struct("start", "size", "ahead", "bucket", "rivals", "whole")).alias("runs"))
    # reads all columns, so that its exchange is the one that the result uses, too
    all_read = (F.col("n_bytes") >= 0) & (F.length("data") >= 0) & F.col("side").isNotNull()
    joined = packed.where(all_read).join(wanted, _KEYS)
    both = joined.select(*_KEYS, "n_bytes", "data", "runs")

    def cut(batches):
        names = [*_KEYS, "start", "size", "ahead", "bucket", "rivals", "whole", "text"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        out, weight = [], 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for i, h, n, data, runs in zip(*(batch.column(c) for c in (*_KEYS, "n_bytes", "data", "runs")), strict=True):
                text = _raw(data.as_py(), n.as_py())
                for r in runs.as_py():
                    part = text[r["start"] : r["start"] + r["size"] + length - 1]
                    out.append((i.as_py(), h.as_py(), r["start"], r["size"], r["ahead"], r["bucket"], r["rivals"], r["whole"], part))
                    weight += len(part)
                if weight > BATCH_BYTES:
                    yield flush()
                    weight = 0
        yield flush()

    return both.mapInArrow(cut, "id_hash long, text_hash long, start long, size int, ahead int, bucket long, rivals long, whole boolean, text binary")


def _sorted_buckets(texts: DataFrame, length: int) -> DataFrame:
    """(id_hash, text_hash, start, size): repeated stretches, from buckets sorted one batch at a time."""
    names = [*_KEYS, "start", "size", "ahead", "bucket", "whole", "text"]

    def sort(batches):
        held: list[list[tuple]] = []  # whole buckets, and the one being read
        weight = 0

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            out = []
            if rows:
                numbers = np.unique([r[5] for r in rows], return_inverse=True)[1]
                columns = ([r[k] for r in rows] for k in (7, 3, 4))
                for row, flags in zip(rows, repeated_suffixes(*columns, numbers, length), strict=True):
                    if not row[6]:
                        out += [(row[0], row[1], row[2] + s, n) for s, n in _stretches(flags)]
            made = list(zip(*out, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in made], names=[*_KEYS, "start", "size"])

        last = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if row[5] != last:
                    if weight > BATCH_BYTES:
                        yield flush([r for bucket in held for r in bucket])
                        held, weight = [], 0
                    held.append([])
                    last = row[5]
                held[-1].append(row)
                weight += len(row[7])
        yield flush([r for bucket in held for r in bucket])

    dealt = texts.repartition("bucket").sortWithinPartitions("bucket").select(*names)
    return dealt.mapInArrow(sort, "id_hash long, text_hash long, start long, size long")


def _counted_buckets(texts: DataFrame, length: int) -> DataFrame:
    """The same for buckets of very many classes: every suffix counted by its digest."""

    def digests(batches):
        for batch in batches:
            for i, h, s, n, text in zip(*(batch.column(c) for c in (*_KEYS, "start", "size", "text")), strict=True):
                n, data = n.as_py(), text.as_py()
                found = b"".join(hashlib.blake2b(data[k : k + length], digest_size=16).digest() for k in range(n))
                d = np.frombuffer(found, dtype="<i8").reshape(-1, 2)
                at = np.arange(n, dtype=np.int64) + s.as_py()
                columns = [pa.array([x.as_py()] * n, pa.int64()) for x in (i, h)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(at), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy())], names=[*_KEYS, "start", "w1", "w2"])

    every = texts.select(*_KEYS, "start", "size", "text").mapInArrow(digests, "id_hash long, text_hash long, start long, w1 long, w2 long")
    often = every.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1")
    return every.join(often, ["w1", "w2"], "left_semi").select(*_KEYS, "start", F.lit(1).cast("long").alias("size"))


def _with_spans(docs: DataFrame, side: list[str], length: int) -> DataFrame:
    """(side, n_bytes, data, spans): ``spans`` are (start, size) of suffixes that repeat."""
    small_batches(docs.sparkSession, BATCH_BYTES)
    small_reads(docs.sparkSession)
    found = keep(_matters(keep(find_runs(docs, length), "runs", ["bucket", "d1", "d2"])), "repeats")
    packed = _packed(docs, side)
    texts = _run_texts(packed, found.where("rivals IS NOT NULL"), length)  # computed twice if there are large buckets
    spans = _sorted_buckets(texts.where(F.col("rivals") <= BUCKET_RUNS), length)
    large = F.col("rivals") > BUCKET_RUNS
    if not found.where(large).isEmpty():
        spans = spans.unionByName(_counted_buckets(texts.where(large), length))
    whole = found.where("whole").select(*_KEYS, "start", F.col("size").cast("long").alias("size"))
    spans = whole.unionByName(spans).groupBy(*_KEYS).agg(F.collect_set(F.struct("start", "size")).alias("spans"))
    return packed.join(spans, _KEYS, "left").select("side", "n_bytes", "data", "spans")


def _cut(data: bytes, spans: list[dict] | None, length: int) -> tuple[bytes, int]:
    """The bytes outside the strings that start in ``spans``, and the number of removed runs."""
    kept, at, runs, reached = [], 0, 0, -1
    for s, n in sorted((x["start"], x["size"]) for x in spans or ()):
        if s > reached:  # not touching the run before
            kept.append(data[max(at, 0) : s])
            runs += 1
        reached = at = max(at, s + n - 1 + length)
    return b"".join([*kept, data[at:]]), runs


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    rows = _with_spans(docs, ["doc_id"], length).select(F.col("side.doc_id").alias("doc_id"), "n_bytes", "data", "spans")
    schema = rows.select("doc_id").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")

    def run(batches):
        for batch in batches:
            out = []
            for n, data, spans in zip(*(batch.column(c) for c in ("n_bytes", "data", "spans")), strict=True):
                text = _raw(data.as_py(), n.as_py())
                kept, runs = _cut(text, spans.as_py(), length)
                out.append((len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
            made = list(zip(*out, strict=True)) or [()] * 4
            arrays = [pa.array(c, pa.int64()) for c in made[:3]] + [pa.array(made[3], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=schema.names)

    return rows.mapInArrow(run, schema)


def strip(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the kept bytes as ``text`` and their length as ``n_chars``, if there is that column.

    A character that loses some of its bytes goes as a whole; a null text stays null."""
    side = [c for c in docs.columns if c != "text"]
    (absent,) = unused(docs, "absent")
    rows = _with_spans(docs.withColumn(absent, F.col("text").isNull()), [*side, absent], length)
    schema = rows.select("side").schema.add("text", "string")

    def run(batches):
        for batch in batches:
            out = []
            for n, data, spans in zip(*(batch.column(c) for c in ("n_bytes", "data", "spans")), strict=True):
                out.append(_cut(_raw(data.as_py(), n.as_py()), spans.as_py(), length)[0].decode(errors="ignore"))
            yield pa.RecordBatch.from_arrays([batch.column("side"), pa.array(out, pa.string())], names=["side", "text"])

    done = rows.mapInArrow(run, schema).withColumn("text", F.when(~F.col("side").getField(absent), F.col("text")))
    made = {"text": F.col("text"), "n_chars": F.coalesce(F.char_length("text").cast("long"), F.col("side").getField("n_chars")) if "n_chars" in side else None}
    return done.select(*[(made[c] if made.get(c) is not None else F.col("side").getField(c)).alias(c) for c in docs.columns])
