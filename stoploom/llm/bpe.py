"""BPE encoding and decoding through a table of distinct words.

Texts are split into pre-tokens ("words") as the tokenizer file says. A task cuts its texts into
blocks of at most about ``BLOCK_WORDS`` distinct words; a text becomes the numbers of its words within its
block. The distinct words of all blocks are sorted by word, each is encoded once, and its ids go
back to every block that holds it, where they are put at their positions. Decoding joins the distinct
ids of each block with the vocabulary, a table of (id, piece), and puts the pieces in the places of the ids.

A frequent word is one row a block, however often it occurs, so no word is a hot key, and nothing is
broadcast but the tokenizer file. Texts and the words of their blocks cross one exchange, by block,
that both the questions (words) and their answers (ids) use.

Defined cases: a null or blank text has no tokens and decodes to an empty text; null or repeated
doc_ids are kept row by row; strings of special tokens inside a text are those tokens, as in the
library; a table without rows gives none. Other columns are ignored. Word numbers follow the order
of a task's rows, so ``docs`` should come from files, as all stages here do, and not straight from a
shuffle, whose order may change when a lost task is run again.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import small_batches

#: A block ends when it has so many distinct words or characters.
BLOCK_WORDS = 1 << 19
BLOCK_CHARS = 1 << 26
#: Words of a block in one row; characters of chunks that are remembered with their words, and of the longest one.
_ROW_WORDS = 1 << 16
_REMEMBERED = 1 << 20
_LONG_CHUNK = 1 << 8
#: Ids of rows of ``encode`` that ``decode`` takes as a block.
_BLOCK_IDS = 1 << 22
#: Encoded words that a task packs together, by block.
_PACKED = 1 << 18
#: Latin letters up to here lower-case and compose alike everywhere; other texts take the library's path.
_PLAIN = re.compile("[^\x00-\x1b\x20-\x84\x86-įı-ɏ]")


class Splitter:
    """Splits texts into words and encodes words, exactly as the tokenizer file says."""

    def __init__(self, spec: str):
        found = json.loads(spec)
        splits = [p for p in found["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        kinds = [n["type"] for n in found["normalizer"]["normalizers"]]
        if len(splits) != 1 or kinds != ["NFC", "Replace", "Lowercase"] or found["decoder"] or found["post_processor"]:
            raise ValueError("the tokenizer file is not of the kind that splits lower-cased words")
        pattern = splits[0]["pattern"]["Regex"]
        self.tokenizer = tokenizers.Tokenizer.from_str(spec)
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        self.plain_words = regex.compile(pattern).findall
        self.split = tokenizers.pre_tokenizers.Split(tokenizers.Regex(pattern), "removed", invert=True)
        self.bytes = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.special = {t["content"]: t["id"] for t in found["added_tokens"]}
        self.known: dict[str, list[str]] = {}
        self.known_chars = 0
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def words(self, text: str | None) -> list[str]:
        chunks = self.chunks(text)
        if chunks is None:
            return self.rare_words(text)
        out: list[str] = []
        for c in chunks:
            out += self.chunk_words(c)
        return out

    def chunks(self, text: str | None) -> list[str] | None:
        """Lower-case runs without white space, which words never cross; None if ``text`` is not plain Latin."""
        if not text:
            return []
        if "<|" in text or _PLAIN.search(text) or not (text.isascii() or unicodedata.is_normalized("NFC", text)):
            return None
        return text.lower().split()

    def chunk_words(self, chunk: str) -> list[str]:
        found = self.known.get(chunk)
        if found is None:
            found = self.plain_words(chunk)
            if len(chunk) <= _LONG_CHUNK:
                if self.known_chars >= _REMEMBERED:
                    self.known.clear()
                    self.known_chars = 0
                self.known[chunk] = found
                self.known_chars += len(chunk)
        return found

    def rare_words(self, text: str) -> list[str]:
        """The library's own path, with special tokens as words of their own."""
        out = []
        for i, part in enumerate(self.special_at.split(text)):
            out += [part] if i % 2 else [w for w, _ in self.split.pre_tokenize_str(self.normalizer.normalize_str(part))]
        return out

    def ids(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        return [t.id for p, _ in self.bytes.pre_tokenize_str(word) for t in self.model.tokenize(p)]

    def pieces(self) -> dict[int, str]:
        """The piece of every id."""
        return {i: piece for piece, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}


def load(path: str) -> str:
    """The tokenizer file's text; tasks get it from the driver, so the path need not exist elsewhere."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers compressed byte by byte: the high bytes are mostly zero."""
    planes = np.ascontiguousarray(numbers, dtype="<u4").view(np.uint8).reshape(-1, 4).T.copy()
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(numbers) else b""


def _unpacked(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, dtype=np.uint32)
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), dtype=np.uint8)
    return planes.reshape(4, n).T.copy().view("<u4").ravel()


def _blocks(docs: DataFrame, spec: str) -> DataFrame:
    """Rows of two kinds, by block: for each text ``n``, its number of words, and ``sequence``, their numbers; and
    rows with ``m`` of the block's ``words``, in order, one a line, with their numbers as ``sequence``.

    Words never hold white space. In order they compress to a third, here and in the exchange by word."""
    slim = docs.select("doc_id", "text")
    schema = StructType([StructField("block", LongType()), slim.schema["doc_id"], StructField("n", LongType())])
    schema = schema.add("sequence", BinaryType()).add("m", LongType()).add("size", LongType()).add("words", BinaryType())

    def run(batches):
        from pyspark import TaskContext

        splitter, numbers, chars = Splitter(spec), {}, 0
        block = TaskContext.get().partitionId() << 32

        def rows(ids: pa.Array, **made: list) -> pa.RecordBatch:
            kinds = {"n": pa.int64(), "sequence": pa.binary(), "m": pa.int64(), "size": pa.int64(), "words": pa.binary()}
            columns = [pa.array(made.get(c, [None] * len(ids)), k) for c, k in kinds.items()]
            return pa.RecordBatch.from_arrays([pa.array([block] * len(ids), pa.int64()), ids, *columns], names=schema.names)

        def words_of_block(kind: pa.DataType) -> pa.RecordBatch:
            listed = sorted(numbers)
            parts = [listed[k : k + _ROW_WORDS] for k in range(0, len(listed), _ROW_WORDS)]
            lines = ["\n".join(p).encode() for p in parts]
            packed = [_packed(np.fromiter(map(numbers.__getitem__, p), dtype=np.uint32, count=len(p))) for p in parts]
            squeezed = [pa.compress(t, codec="zstd", asbytes=True) for t in lines]
            return rows(pa.nulls(len(parts), kind), sequence=packed, m=list(map(len, parts)), size=list(map(len, lines)), words=squeezed)

        for batch in batches:
            ids = batch.column("doc_id")
            at, sizes, sequences = 0, [], []
            for k, text in enumerate(batch.column("text")):
                text = text.as_py()
                words = splitter.words(text)
                sequences.append(_packed(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.uint32, count=len(words))))
                sizes.append(len(words))
                chars += len(text or "")
                if len(numbers) >= BLOCK_WORDS or chars >= BLOCK_CHARS:
                    yield rows(ids.slice(at, k + 1 - at), n=sizes, sequence=sequences)
                    yield words_of_block(ids.type)
                    at, sizes, sequences, numbers, chars = k + 1, [], [], {}, 0
                    block += 1
            yield rows(ids.slice(at), n=sizes, sequence=sequences)
        if numbers:
            yield words_of_block(ids.type)

    # one exchange for texts and words: both readers take all its columns
    return slim.mapInArrow(run, schema).repartition("block")


def _block_words(blocks: DataFrame) -> DataFrame:
    """(block, number, word) of every distinct word of every block."""

    def run(batches):
        for batch in batches:
            for row in batch.filter(pc.is_valid(batch.column("m"))).to_pylist():
                words = pa.decompress(row["words"], decompressed_size=row["size"], codec="zstd", asbytes=True).decode().split("\n")
                numbers = _unpacked(row["sequence"], row["m"]).astype(np.int32)
                columns = [pa.array([row["block"]] * len(words), pa.int64()), pa.array(numbers), pa.array(words, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "number", "word"])

    return blocks.mapInArrow(run, "block long, number int, word string")


def encoded_words(words: DataFrame, spec: str) -> DataFrame:
    """(block, n, numbers, sizes, ids) from (block, number, word): each distinct word encoded once, and its ids
    packed with those of other words of the block."""

    def encode(batches):
        splitter = Splitter(spec)
        held: dict[int, tuple[list, list, list]] = {}
        count, last, ids = 0, None, []

        def flush() -> pa.RecordBatch:
            blocks = list(held)
            packed = [[_packed(np.array(held[b][k], dtype=np.int64).astype(np.uint32)) for b in blocks] for k in range(3)]
            columns = [pa.array(blocks, pa.int64()), pa.array([len(held[b][0]) for b in blocks], pa.int64()), pa.array([len(held[b][2]) for b in blocks], pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays([*columns, *(pa.array(p, pa.binary()) for p in packed)], names=["block", "n", "n_ids", "numbers", "sizes", "ids"])

        for batch in batches:
            for block, number, word in zip(*(batch.column(c).to_pylist() for c in ("block", "number", "word")), strict=True):
                if word != last:  # words come in order
                    last, ids = word, splitter.ids(word)
                if block not in held:
                    held[block] = ([], [], [])
                numbers, sizes, flat = held[block]
                numbers.append(number)
                sizes.append(len(ids))
                flat += ids
                count += 1
            if count >= _PACKED:
                yield flush()
                count = 0
        yield flush()

    in_order = words.repartition("word").sortWithinPartitions("word")
    return in_order.mapInArrow(encode, "block long, n long, n_ids long, numbers binary, sizes binary, ids binary")


class WordIds:
    """The ids of a block's words by number."""

    def __init__(self, rows: list[dict]):
        sizes = [_unpacked(r["sizes"], r["n"]).astype(np.int64) for r in rows]
        numbers = [_unpacked(r["numbers"], r["n"]).astype(np.int64) for r in rows]
        flat = [_unpacked(r["ids"], r["n_ids"]) for r in rows]
        whole = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, dtype=kind)
        self.flat, listed, number = whole(flat, np.uint32), whole(sizes, np.int64), whole(numbers, np.int64)
        self.begins, self.sizes = np.empty(len(number), dtype=np.int64), np.empty(len(number), dtype=np.int64)
        self.begins[number], self.sizes[number] = np.cumsum(listed) - listed, listed

    def of(self, sequence: bytes, n: int) -> np.ndarray:
        """The ids of a text, each word's at its position."""
        words = _unpacked(sequence, n)
        sizes = self.sizes[words]
        ends = np.cumsum(sizes)
        return self.flat[np.arange(ends[-1] if n else 0) + np.repeat(self.begins[words] - (ends - sizes), sizes)]


def vocabulary(spark: SparkSession, spec: str) -> DataFrame:
    """(id, piece) of the tokenizer, a table as large as its file."""
    ids, pieces = zip(*sorted(Splitter(spec).pieces().items()), strict=True)
    return spark.createDataFrame(pa.table({"id": pa.array(ids, pa.int32()), "piece": pa.array(pieces, pa.string())}))


def _distinct_ids(rows: DataFrame) -> DataFrame:
    """(block, id) of the distinct ids of each row's ``answers``, an array with ``n_ids`` and ``ids``."""

    def run(batches):
        for batch in batches:
            for block, answers in zip(batch.column("block").to_pylist(), batch.column("answers").to_pylist(), strict=True):
                found = [np.unique(_unpacked(a["ids"], a["n_ids"])) for a in answers]
                ids = np.unique(np.concatenate(found)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), block, np.int64)), pa.array(ids)], names=["block", "id"])

    return rows.select("block", "answers").mapInArrow(run, "block long, id int")


def _pieces_of(used: DataFrame, pieces: DataFrame) -> DataFrame:
    """(block, piece_ids, pieces) from the distinct ids (block, id) of each block: every id joined with its piece."""
    pairs = F.array_sort(F.collect_list(F.struct("id", "piece"))).alias("pairs")
    listed = used.join(pieces, "id").groupBy("block").agg(pairs)
    return listed.select("block", F.col("pairs.id").alias("piece_ids"), F.col("pairs.piece").alias("pieces"))


class Pieces:
    """The joined pieces of a block, and its ids in decimal, by id."""

    def __init__(self, rows: pa.Table):
        row = rows.slice(0, 1).to_pylist()[0] if rows.num_rows else {}
        ids, pieces = row.get("piece_ids") or [], row.get("pieces") or []
        self.at = np.zeros(max(ids, default=-1) + 1, dtype=np.int64)
        self.at[ids] = np.arange(len(ids))
        self.pieces, self.decimal = (np.array(list(x), dtype=object) for x in (pieces, map(str, ids)))

    def of(self, ids: np.ndarray) -> list[str]:
        return self.pieces[self.at[ids]].tolist()

    def numbers(self, ids: np.ndarray) -> list[str]:
        return self.decimal[self.at[ids]].tolist()


def encode(docs: DataFrame, spec: str) -> DataFrame:
    """(doc_id, n_tokens, ids): ids as compressed 32-bit numbers, see ``unpack``."""
    return _finished(docs, spec, lambda ids, pieces: (len(ids), _packed(ids)), "n_tokens long, ids binary", False)


def digests(docs: DataFrame, spec: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the ids and of the text decoded from them."""
    sha = lambda parts: hashlib.sha256(" ".join(parts).encode()).hexdigest()

    def row(ids: np.ndarray, pieces: Pieces) -> tuple:
        return len(ids), sha(pieces.numbers(ids)), sha(pieces.of(ids))

    return _finished(docs, spec, row, "n_tokens long, ids_sha256 string, decoded_sha256 string", True)


def unpack(ids: bytes, n_tokens: int) -> list[int]:
    """The ids of a row of ``encode``."""
    return _unpacked(ids, n_tokens).tolist()


def _finished(docs: DataFrame, spec: str, row, columns: str, decoded: bool) -> DataFrame:
    """``row`` of every text's ids and, if ``decoded``, the pieces of its block."""
    spark = docs.sparkSession
    small_batches(spark)
    blocks = _blocks(docs, spec)
    answers = encoded_words(_block_words(blocks), spec)
    # one row a block: the decoder uses this exchange, too, and the join below keeps its partitions
    listed = answers.groupBy("block").agg(F.collect_list(F.struct("n", "n_ids", "numbers", "sizes", "ids")).alias("answers"))
    if decoded:
        listed = listed.join(_pieces_of(_distinct_ids(listed), vocabulary(spark, spec)), "block", "left")
    doc_type = blocks.schema["doc_id"].dataType.simpleString()
    names = [c.split()[0] for c in columns.split(", ")]
    types = [{"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[c.split()[1]] for c in columns.split(", ")]

    def finish(texts: pa.Table, words: pa.Table) -> pa.Table:
        """One block: at most about ``BLOCK_CHARS`` characters."""
        texts = texts.filter(pc.is_valid(texts.column("n")))
        ids = WordIds([a for part in words.column("answers").to_pylist() for a in part])
        pieces = Pieces(words) if decoded else None
        out = [row(ids.of(s.as_py(), n.as_py()), pieces) for n, s in zip(texts.column("n"), texts.column("sequence"), strict=True)]
        made = list(zip(*out, strict=True)) or [()] * len(names)
        arrays = [pa.array(m, t) for m, t in zip(made, types, strict=True)]
        return pa.table([texts.column("doc_id"), *arrays], names=["doc_id", *names])

    both = blocks.groupBy("block").cogroup(listed.groupBy("block"))
    return both.applyInArrow(finish, f"doc_id {doc_type}, {columns}")


def decode(encoded: DataFrame, spec: str) -> DataFrame:
    """(doc_id, text) of rows of ``encode``: every id joined with its piece, joined by one space. Blocks follow the order
    of a task's rows, so ``encoded`` should come from files."""
    spark = encoded.sparkSession
    small_batches(spark)
    slim = encoded.select("doc_id", "n_tokens", "ids")
    kind = slim.schema["doc_id"].dataType.simpleString()
    numbered = StructType([StructField("block", LongType()), *slim.schema.fields])

    def number(batches):
        from pyspark import TaskContext

        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            blocks = []
            for n in batch.column("n_tokens").to_pylist():
                if held >= _BLOCK_IDS:
                    block, held = block + 1, 0
                held += n
                blocks.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), *batch.columns], names=numbered.names)

    rows = slim.mapInArrow(number, numbered).repartition("block")
    one = F.array(F.struct(F.col("n_tokens").alias("n_ids"), F.col("ids"))).alias("answers")
    pieces = _pieces_of(_distinct_ids(rows.select("block", one)).distinct(), vocabulary(spark, spec))

    def finish(texts: pa.Table, found: pa.Table) -> pa.Table:
        block = Pieces(found)
        made = [" ".join(block.of(_unpacked(i.as_py(), n.as_py()))) for n, i in zip(texts.column("n_tokens"), texts.column("ids"), strict=True)]
        return pa.table([texts.column("doc_id"), pa.array(made, pa.string())], names=["doc_id", "text"])

    return rows.groupBy("block").cogroup(pieces.groupBy("block")).applyInArrow(finish, f"doc_id {kind}, text string")
