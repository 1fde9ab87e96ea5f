"""Alignment of two tokenizations of the same text: which tokens cover the same bytes, and how usual that is.

Tokenizer A reads a blank and the text, B the text (it adds the blank itself); both sequences cut the same line
of bytes. As sparse 0/1 matrices in CSR form, rows tokens and columns bytes, A·Bᵀ has an entry for every pair
of tokens that overlap, its value the number of bytes they share: the links. The product is Gustavson's, row
by row: the row of a token of A is the sum of the rows of Bᵀ at its bytes. Where tokens of both end at one
byte the line is cut into groups; of the matrices with columns groups, the product links all tokens of a group.

Work is done once for each distinct word. Neither tokenizer merges across a single blank between two other
characters: A's pattern begins a piece there, and no entry of B holds a blank behind another character (checked
when B is loaded; else a text is one word). So every such place is an end of tokens of both, and a
text's tokens, groups and links are those of its words one after another. Texts are taken in blocks of
``BLOCK_CHARS``; a block's distinct words lie on one line of bytes, whose matrices are block-diagonal.

How often ids link is counted over the corpus: blocks count their own texts, an aggregation adds
them up, and each block gets the sums of its own pairs back by a join. So no table of all pairs is
broadcast, and what one task holds is bounded by the block (and by one text, if that is longer).

Defined cases: a null or empty text has no tokens, nor has one that either tokenizer does not give back byte
by byte: zeros and an empty digest. Rows that repeat a doc_id or a text are rows, and texts, of their
own. Other columns are never looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from .common import keep, small_batches

#: Characters of text in a block.
BLOCK_CHARS = 6 << 20
#: Entries that a product looks at together.
_ENTRIES = 1 << 18
#: Words encoded in one call.
_BATCH = 1 << 13
#: A single blank between two characters that are not white space.
_CUT = re.compile(r" (?<=\S )(?=\S)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


# --- matrices ----------------------------------------------------------------------------------


@dataclass
class Csr:
    """A sparse matrix: row i has ``values[k]`` in column ``columns[k]`` for k from ``starts[i]`` to ``starts[i + 1]``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @staticmethod
    def of_runs(ends: np.ndarray) -> Csr:
        """Row i has ones in the columns from the end before to ``ends[i]``."""
        n = int(ends[-1]) if len(ends) else 0
        return Csr(np.concatenate(([0], ends)).astype(np.int64), np.arange(n, dtype=np.int64), np.ones(n, dtype=np.int64), n)

    @staticmethod
    def of_columns(columns: np.ndarray, width: int) -> Csr:
        """Row i has a single one, in ``columns[i]``."""
        n = len(columns)
        return Csr(np.arange(n + 1, dtype=np.int64), columns.astype(np.int64), np.ones(n, dtype=np.int64), width)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.columns, minlength=self.width)))).astype(np.int64)
        return Csr(starts, self.rows()[order], self.values[order], len(self.starts) - 1)

    def times(self, other: Csr) -> Csr:
        """The product, some rows of this matrix at a time: each entry brings the row of ``other`` that its column
        names, times its value; entries that fall into one place add up."""
        sizes = np.diff(other.starts)
        brought = np.concatenate(([0], np.cumsum(sizes[self.columns]))).astype(np.int64)
        ends = brought[self.starts]  # entries brought before each row
        n = len(self.starts) - 1
        counts, columns, values, row = np.zeros(n + 1, dtype=np.int64), [], [], 0
        while row < n:
            last = max(row + 1, int(np.searchsorted(ends, ends[row] + _ENTRIES, side="right")) - 1)
            own = slice(int(self.starts[row]), int(self.starts[last]))
            cols, many = self.columns[own], sizes[self.columns[own]]
            at = np.arange(int(many.sum())) + np.repeat(other.starts[cols] - (np.cumsum(many) - many), many)
            rows = np.repeat(np.repeat(np.arange(row, last), np.diff(self.starts[row : last + 1])), many)
            keys = (rows - row) * other.width + other.columns[at]
            order = np.argsort(keys, kind="stable")
            keys, found = keys[order], (np.repeat(self.values[own], many) * other.values[at])[order]
            new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, dtype=np.int64)
            columns.append(keys[new] % other.width if len(new) else new)
            values.append(np.add.reduceat(found, new) if len(new) else new)
            counts[row + 1 : last + 1] = np.bincount(keys[new] // other.width, minlength=last - row) if len(new) else 0
            row = last
        whole = lambda parts: np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
        return Csr(np.cumsum(counts), whole(columns), whole(values), other.width)


# --- tokenizers --------------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others
    numbered from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, from the contents of their files."""

    def __init__(self, spec_a: str, model_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task a core
        self.a = tokenizers.Tokenizer.from_str(spec_a)
        self.a.encode_special_tokens = True  # their strings inside texts are plain text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        letters = _byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [self._of_piece(p) for p in pieces]
        self.sizes = [np.fromiter(map(len, t), dtype=np.int64, count=len(t)) for t in (self.a_bytes, self.b_bytes)]
        # ids as text, followed by what stands between tokens, at a group's and at a word's end
        behind = ((",", "|"), (",", ";", "\n"))
        self.named = [np.array([[f"{i}{c}" for i in range(len(t))] for c in ends], dtype=object) for t, ends in zip((self.a_bytes, self.b_bytes), behind, strict=True)]
        self.by_words = not any(re.search("[^▁]▁", p) for p in pieces)

    @staticmethod
    def _of_piece(piece: str) -> bytes:
        byte = _BYTE_PIECE.fullmatch(piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def words(self, text: str | None) -> list[str]:
        if not text:
            return []
        return _CUT.split(text) if self.by_words else [text]

    def ids(self, words: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a, b = [], []
        for k in range(0, len(words), _BATCH):
            some = words[k : k + _BATCH]
            a += [e.ids for e in self.a.encode_batch_fast([" " + w for w in some], add_special_tokens=False)]
            b += self.b.encode(some, num_threads=1)
        return a, b


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    flat = np.fromiter(itertools.chain.from_iterable(lists), dtype=np.int64, count=int(sizes.sum()))
    return flat, np.concatenate(([0], np.cumsum(sizes)))


def _spread(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places from ``starts[r]`` to ``starts[r + 1]`` of each r in ``rows``, and how many each has."""
    sizes = starts[rows + 1] - starts[rows]
    return np.arange(int(sizes.sum())) + np.repeat(starts[rows] - (np.cumsum(sizes) - sizes), sizes), sizes


def _given_back(lines: list[bytes], ids: list[list[int]], table: list[bytes]) -> np.ndarray:
    """Whether the bytes of each line's tokens, joined, are the line."""
    same = (b"".join(map(table.__getitem__, x)) == line for x, line in zip(ids, lines, strict=True))
    return np.fromiter(same, dtype=bool, count=len(lines))


class Words:
    """Words side by side on one line of bytes, with the tokens of both tokenizers, their links and groups.

    ``a``, ``b``: ids; ``a_at``, ``b_at``, ``link_at``, ``group_at``: where each word's tokens, links, groups start.
    ``good``: both tokenizers give the word back. Words that aren't good have no tokens."""

    def __init__(self, tok: Tokenizers, words: list[str]):
        ids_a, ids_b = tok.ids(words)
        lines = [b" " + w.encode() for w in words]
        self.good = _given_back(lines, ids_a, tok.a_bytes) & _given_back(lines, ids_b, tok.b_bytes)
        for k in np.flatnonzero(~self.good).tolist():
            ids_a[k], ids_b[k] = [], []
        self.a, self.a_at = _flat(ids_a)
        self.b, self.b_at = _flat(ids_b)
        ends = [np.cumsum(tok.sizes[x][i]) for x, i in enumerate((self.a, self.b))]
        by_a, by_b = Csr.of_runs(ends[0]), Csr.of_runs(ends[1])
        self.links = by_a.times(by_b.transposed())
        self.link_at = self.links.starts[self.a_at]
        # groups end where tokens of both end
        cuts = np.intersect1d(*ends, assume_unique=True)
        of_a, of_b = (np.searchsorted(cuts, e) for e in ends)
        self.a_groups, self.b_groups = Csr.of_columns(of_a, len(cuts)), Csr.of_columns(of_b, len(cuts))
        self.group_at = np.concatenate((of_a, [len(cuts)]))[self.a_at] if len(cuts) else np.zeros(len(words) + 1, dtype=np.int64)

    def shared(self) -> Csr:
        """All tokens of A and B in one group; large where groups are, so not for every text of a corpus."""
        return self.a_groups.times(self.b_groups.transposed())

    def texts(self, tok: Tokenizers) -> list[str]:
        """The groups of each word as text: every id with what stands behind it, ids of A before those of B."""
        if not len(self.good):
            return []
        starts_a, starts_b = (m.transposed().starts for m in (self.a_groups, self.b_groups))
        of_a, of_b = self.a_groups.columns, self.b_groups.columns
        last_a, last_b = (np.zeros(len(x), dtype=np.int64) for x in (of_a, of_b))
        last_a[starts_a[1:] - 1] = last_b[starts_b[1:] - 1] = 1
        last_b[self.b_at[1:][np.diff(self.b_at) > 0] - 1] = 2
        parts = np.empty(len(of_a) + len(of_b), dtype=object)
        parts[np.arange(len(of_a)) + starts_b[of_a]] = tok.named[0][last_a, self.a]
        parts[np.arange(len(of_b)) + starts_a[of_b + 1]] = tok.named[1][last_b, self.b]
        out = [""] * len(self.good)
        some = np.flatnonzero(np.diff(self.a_at)).tolist()
        for k, line in zip(some, "".join(parts.tolist()).split("\n"), strict=False):
            out[k] = line
        return out


def load(path_a: str, path_b: str) -> tuple[str, bytes]:
    """Both files' contents; tasks get them from the driver, so the paths need not exist elsewhere."""
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        return a.read(), b.read()


# --- the job -----------------------------------------------------------------------------------


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class _Block:
    """Texts read together: their words by number, then what is known of them."""

    def __init__(self, tok: Tokenizers):
        self.tok, self.numbers, self.rows, self.chars = tok, _Numbers(), [], 0

    def add(self, text: str | None) -> None:
        words = self.tok.words(text)
        self.rows.append(np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int64, count=len(words)))
        self.chars += len(text or "")

    def known(self) -> tuple[Words, list[np.ndarray]]:
        """The words, and each text's words by number; none for texts that are not given back."""
        words = Words(self.tok, list(self.numbers))
        empty = np.empty(0, dtype=np.int64)
        return words, [r if len(r) and words.good[r].all() else empty for r in self.rows]


_STATS = ("n_a", "n_b", "n_groups", "n_links")


def _squeezed(numbers: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(numbers, dtype="<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True) if len(numbers) else b""


def _expanded(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, dtype=np.int64)
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), dtype=np.uint8)
    return planes.reshape(4, n).T.copy().view("<u4").ravel().astype(np.int64)


def _blocks(docs: DataFrame, spec: tuple[str, bytes], doc_id: str, text: str, chars: int) -> DataFrame:
    """Rows of two kinds, by block. For each text its figures and ``words``, the numbers of its words in order of number
    (only sums over them are needed). For each block the ``pairs`` of ids that its words link, in how many of its
    texts each stands (``held``), and the pairs of each word (``words``: places, and ``sizes``)."""
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = StructType([StructField("block", LongType()), slim.schema["doc_id"]])
    for name in (*_STATS, "n_words", "n_sizes"):
        schema = schema.add(name, LongType())
    schema = schema.add("digest", StringType()).add("words", BinaryType()).add("sizes", BinaryType())
    schema = schema.add("pairs", ArrayType(LongType())).add("held", ArrayType(LongType()))
    kinds = {n: pa.int64() for n in (*_STATS, "n_words", "n_sizes")} | {"digest": pa.string(), "words": pa.binary(), "sizes": pa.binary()}
    kinds |= {"pairs": pa.list_(pa.int64()), "held": pa.list_(pa.int64())}

    def run(batches):
        from pyspark import TaskContext

        tok, number = Tokenizers(*spec), TaskContext.get().partitionId() << 32
        block, ids, kind = _Block(tok), [], None

        def made(ids: pa.Array, rows: list[dict]) -> pa.RecordBatch:
            columns = [pa.array([r.get(c) for r in rows], k) for c, k in kinds.items()]
            return pa.RecordBatch.from_arrays([pa.array([number] * len(rows), pa.int64()), ids, *columns], names=schema.names)

        def flush():
            words, rows = block.known()
            sums = np.stack([np.diff(x) for x in (words.a_at, words.b_at, words.group_at, words.link_at)])
            texts = words.texts(tok)
            # pairs of ids, numbered in the block
            pairs = words.a[words.links.rows()] << 32 | words.b[words.links.columns]
            distinct, place = np.unique(pairs, return_inverse=True)
            out, held = [], np.zeros(len(distinct), dtype=np.int64)
            some, weight = [], 0

            def count() -> None:
                """Texts that hold each pair: each text's pairs once."""
                nonlocal some, weight
                if weight:
                    at, sizes = zip(*(_spread(words.link_at, w) for w in some), strict=True)
                    rows = np.repeat(np.arange(len(some)), [int(s.sum()) for s in sizes])
                    keys = np.unique(rows * len(distinct) + place[np.concatenate(at)])
                    held[:] += np.bincount(keys % len(distinct), minlength=len(distinct))
                some, weight = [], 0

            for row in rows:
                listed = row.tolist()
                in_order = np.sort(row)
                steps = np.diff(in_order, prepend=-1)
                once = in_order[steps > 0]
                some.append(once)
                weight += int((words.link_at[once + 1] - words.link_at[once]).sum())
                if weight > 1 << 20:
                    count()
                digest = hashlib.sha256(";".join([texts[w] for w in listed]).encode()).hexdigest() if listed else ""
                out.append(dict(zip(_STATS, sums[:, row].sum(axis=1).tolist(), strict=True)) | {"n_words": len(row), "digest": digest, "words": _squeezed(steps)})
            count()
            yield made(pa.concat_arrays(ids), out)
            if len(distinct):
                own = {"n_words": len(place), "words": _squeezed(place), "n_sizes": len(words.good), "sizes": _squeezed(np.diff(words.link_at))}
                yield made(pa.nulls(1, kind), [own | {"pairs": distinct, "held": held}])

        for batch in batches:
            column, texts, begin = batch.column("doc_id"), batch.column("text"), 0
            kind = column.type
            for k, value in enumerate(texts):
                block.add(value.as_py())
                if block.chars >= chars:
                    ids.append(column.slice(begin, k + 1 - begin))
                    yield from flush()
                    block, ids, begin, number = _Block(tok), [], k + 1, number + 1
            if begin < len(column):
                ids.append(column.slice(begin))
        if ids:
            yield from flush()

    return slim.mapInArrow(run, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): in how many texts each pair of ids is linked; ``best``: no pair of its A id is in more."""
    each = blocks.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "held")).alias("x"))
    counts = each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.held").alias("n"))
    counts = keep(counts, "pair-counts")
    first = F.shiftright("pair", 32)
    most = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return counts.join(most, first == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, spec: tuple[str, bytes], doc_id: str = "doc_id", text: str = "text", chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    ``n_best``: links whose pair of ids is the one in most texts among those of its A id; ``count_sum``: over
    all links, the number of texts that hold their pair linked."""
    small_batches(docs.sparkSession)
    blocks = keep(_blocks(docs, spec, doc_id, text, chars), "aligned")
    wanted = blocks.where("pairs IS NOT NULL").select("block", F.posexplode("pairs").alias("at", "pair"))
    answers = wanted.join(pair_counts(blocks), "pair").select(F.col("block").alias("of"), "at", "n", "best")
    kind = blocks.schema["doc_id"].dataType.simpleString()
    slim = blocks.select("block", "doc_id", *_STATS, "n_words", "n_sizes", "digest", "words", "sizes")

    def finish(rows: pa.Table, found: pa.Table) -> pa.Table:
        """One block."""
        own = pc.is_valid(rows.column("n_sizes"))
        texts, block = rows.filter(pc.invert(own)), rows.filter(own).to_pylist()
        sums = np.zeros((2, 1), dtype=np.int64)
        if block:
            at = found.column("at").to_numpy()
            seen = np.zeros((2, len(at)), dtype=np.int64)
            seen[0, at], seen[1, at] = found.column("best").to_numpy().astype(np.int64), found.column("n").to_numpy()
            place, sizes = (_expanded(block[0][c], block[0][n]) for c, n in (("words", "n_words"), ("sizes", "n_sizes")))
            ends = np.concatenate(([0], np.cumsum(sizes)))
            totals = np.concatenate((np.zeros((2, 1), dtype=np.int64), np.cumsum(seen[:, place], axis=1)), axis=1)
            sums = totals[:, ends[1:]] - totals[:, ends[:-1]]
        made = [sums[:, np.cumsum(_expanded(w.as_py(), n.as_py())) - 1].sum(axis=1) for w, n in zip(texts.column("words"), texts.column("n_words"), strict=True)]
        best, total = (pa.array([int(m[k]) for m in made], pa.int64()) for k in range(2))
        columns = [texts.column("doc_id"), *(texts.column(c) for c in _STATS), best, total, texts.column("digest")]
        return pa.table(columns, names=["doc_id", *_STATS, "n_best", "count_sum", "groups_sha256"])

    both = slim.groupBy("block").cogroup(answers.groupBy("of"))
    return both.applyInArrow(finish, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def links(docs: DataFrame, spec: tuple[str, bytes], shared: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, a_at, b_at, a_id, b_id, n_bytes): one row for each link of every text, tokens by place, with the bytes
    that both cover. With ``shared`` one row for each two tokens of one group (a product of their numbers)."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tok = Tokenizers(*spec)
        for batch in batches:
            for k, value in enumerate(batch.column("text")):
                words = Words(tok, tok.words(value.as_py()))
                if not len(words.good) or not words.good.all():
                    continue
                found = words.shared() if shared else words.links
                rows = found.rows()
                for at in range(0, len(rows), 1 << 16):
                    r, c = rows[at : at + (1 << 16)], found.columns[at : at + (1 << 16)]
                    ids = batch.column("doc_id").take(pa.array([k] * len(r)))
                    numbers = [r, c, words.a[r], words.b[c], found.values[at : at + (1 << 16)]]
                    yield pa.RecordBatch.from_arrays([ids, *map(pa.array, numbers)], names=["doc_id", "a_at", "b_at", "a_id", "b_id", "n_bytes"])

    return slim.mapInArrow(run, f"doc_id {kind}, a_at long, b_at long, a_id long, b_id long, n_bytes long")
