"""A sink that splits rows into accepted and rejected ones and counts them exactly once.

Every task writes its rows to files of its own names and returns their counts as its commit message.
Spark hands over one message for each partition, that of the attempt it took, whatever attempts failed,
ran twice or were lost with their executor. The commit keeps the files that messages name, adds up the
counts, and puts the whole folder in the place of the old one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from stoploom.operators.quality import REASON, tag_rejects

FORMAT = "stoploom_counted"
#: Bytes that a task holds before it writes a row group.
GROUP_BYTES = 32 << 20


class Written(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame
    counts: DataFrame


@dataclass
class Part(WriterCommitMessage):
    """What one task has written: its files and its counts."""

    files: list[str]
    counts: dict[str, int]


class _Pieces:
    """One Parquet file of a task, opened with its first rows."""

    def __init__(self, folder: str, kind: str):
        self.store, place = fs.FileSystem.from_uri(folder)
        self.name = f"{kind}/{uuid.uuid4().hex}.parquet"
        self.place, self.file, self.held, self.size = f"{place}/{self.name}", None, [], 0

    def add(self, batch: pa.RecordBatch) -> None:
        if batch.num_rows:
            self.held.append(batch)
            self.size += batch.nbytes
            if self.size >= GROUP_BYTES:
                self.flush()

    def flush(self) -> None:
        if self.held:
            rows = pa.Table.from_batches(self.held)
            self.file = self.file or pq.ParquetWriter(self.place, rows.schema, filesystem=self.store)
            self.file.write_table(rows, row_group_size=rows.num_rows)
            self.held, self.size = [], 0

    def close(self) -> list[str]:
        """The file's name, if there were rows."""
        self.flush()
        if self.file is None:
            return []
        self.file.close()
        return [self.name]


class CountedWriter(DataSourceArrowWriter):
    def __init__(self, staged: str, target: str, reason: str, reasons: list[str], notes: dict[str, str]):
        self.staged, self.target, self.reason, self.reasons, self.notes = staged, target, reason, reasons, notes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        counts = dict.fromkeys(["rows", *self.reasons, *self.notes, "accepted"], 0)
        kept, left = _Pieces(self.staged, "accepted"), _Pieces(self.staged, "rejected")
        for batch in iterator:
            reason = batch.column(self.reason)
            counts["rows"] += batch.num_rows
            for found in pc.value_counts(reason.drop_null()).to_pylist():
                counts[found["values"]] += found["counts"]
            for note, column in self.notes.items():
                counts[note] += pc.sum(batch.column(column)).as_py() or 0
            good = pc.is_null(reason)
            counts["accepted"] += pc.sum(good).as_py() or 0
            rows = batch.drop_columns(list(self.notes.values()))
            kept.add(rows.filter(good).drop_columns([self.reason]))
            left.add(rows.filter(pc.invert(good)))
        return Part(kept.close() + left.close(), counts)

    def commit(self, messages: list[Part | None]) -> None:
        store, staged = fs.FileSystem.from_uri(self.staged)
        target = fs.FileSystem.from_uri(self.target)[1]
        parts = [m for m in messages if m is not None]
        named = {f for m in parts for f in m.files}
        for kind in ("accepted", "rejected"):  # files of attempts that Spark did not take
            for found in store.get_file_info(fs.FileSelector(f"{staged}/{kind}")):
                if f"{kind}/{found.base_name}" not in named:
                    store.delete_file(found.path)
        total = {name: sum(m.counts[name] for m in parts) for name in ["rows", *self.reasons, *self.notes, "accepted"]}
        store.create_dir(f"{staged}/counts")
        with store.open_output_stream(f"{staged}/counts/part-00000.json") as out:
            out.write(json.dumps(total).encode())
        if store.get_file_info(target).type != fs.FileType.NotFound:
            store.delete_dir(target)
        store.move(staged, target)

    def abort(self, messages: list[Part | None]) -> None:
        store, staged = fs.FileSystem.from_uri(self.staged)
        if store.get_file_info(staged).type != fs.FileType.NotFound:
            store.delete_dir(staged)


class CountedSource(DataSource):
    """The write side of :func:`write_counted`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def writer(self, schema: StructType, overwrite: bool) -> CountedWriter:
        o = self.options
        return CountedWriter(o["staged"], o["target"], o["reason"], json.loads(o["reasons"]), json.loads(o["notes"]))


def _free(taken: set[str], name: str) -> str:
    while name.lower() in taken:
        name += "_"
    taken.add(name.lower())
    return name


def write_counted(
    df: DataFrame, path: str, rules: Mapping[str, Column], notes: Mapping[str, Column] | None = None
) -> Written:
    """Rows that no rule rejects below ``path/accepted``, the others with ``reject_reason`` below ``path/rejected``,
    and the counts of :func:`count_rejects` below ``path/counts``, in one pass over ``df``.

    The counts are those of the files: each row counts once, also if tasks are run again. ``path`` keeps what it
    held until all rows are written; between the removal of the old folder and the renaming of the new
    one there is a moment without it. The store must be one that Arrow's file systems open. A
    column ``reject_reason`` of ``df`` is replaced. An empty ``df`` gives empty folders and counts of zero.
    """
    spark, notes = df.sparkSession, dict(notes or {})
    for name in ("rows", "accepted"):
        if name in rules or name in notes:
            raise ValueError(f"{name!r} is the name of a count")
    if rules.keys() & notes.keys():
        raise ValueError("a note has the name of a rule")
    taken = {c.lower() for c in df.columns} | {REASON}
    flags = {note: _free(taken, f"note_{i}") for i, note in enumerate(notes)}
    # notes are taken before a column named like the reason is replaced
    noted = df.select("*", *(F.coalesce(notes[n], F.lit(False)).alias(c) for n, c in flags.items()))
    tagged = tag_rejects(noted, rules)
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path.rstrip("/"))
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    target = f"{store.makeQualified(target)}"
    staged = f"{target}-parts-{uuid.uuid4().hex}"
    for kind in ("accepted", "rejected"):
        store.mkdirs(hadoop.Path(f"{staged}/{kind}"))
    spark.dataSource.register(CountedSource)
    options = {"staged": staged, "target": target, "reason": REASON, "reasons": json.dumps(list(rules)), "notes": json.dumps(flags)}
    tagged.write.format(FORMAT).mode("append").options(**options).save()
    plain = tagged.drop(*flags.values())
    accepted = spark.read.schema(plain.drop(REASON).schema).parquet(f"{target}/accepted")
    rejected = spark.read.schema(plain.schema).parquet(f"{target}/rejected")
    names = ["rows", *rules, *notes, "accepted"]
    counts = spark.read.schema(", ".join(f"`{n}` long" for n in names)).json(f"{target}/counts")
    return Written(accepted, rejected, counts)
