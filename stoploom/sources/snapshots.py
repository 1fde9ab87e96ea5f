"""Merging a tree of dated snapshot folders whose file headers differ.

The tree is ``<root>/<feed>/.../<YYYY-MM-DD>/<table>.txt``; the date folder may also be
written as ``name=YYYY-MM-DD``.

Tasks list the files and read their first lines into a table, the manifest: path, feed, day, table
and header of each file. The data of a table is one scan of the whole tree by position, as wide as the
widest header; a row is joined with its file's line of the manifest, which says where each column
stands. The driver holds the distinct headers and feed folders, never a list of files, and the plan names
nothing but the root.
"""

from __future__ import annotations

import csv
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stoploom.functions.clock import snapshot_day
from stoploom.functions.text import field_count
from stoploom.operators.typing import with_types

STAMPED = ("feed_id", "subdir", "snapshot_date")
#: Bytes that a header is looked for in at a time.
HEADER_BLOCK = 1 << 14


@dataclass(frozen=True)
class SnapshotFile:
    """A file of the tree and its first line."""

    path: str
    feed: str
    day: date
    table: str
    header: str


def _decoded(column: Column) -> Column:
    return F.url_decode(F.replace(column, F.lit("+"), F.lit("%2B")))


def _path_pattern(root: str) -> str:
    """Groups: path up to the feed, feed, date."""
    local = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/")
    day = r"(?:[^/=]+=)?(\d{4}-\d{2}-\d{2})"
    return rf"^([^/]*?(?://[^/]*)?\Q{local}\E/)([^/]+)/(?:.*/)?{day}/[^/]+$"


def manifest(
    spark: SparkSession,
    root: str,
    tables: Sequence[str],
    feeds: Sequence[str] | None = None,
    first_day: date | str | None = None,
    last_day: date | str | None = None,
    file_glob: str | None = None,
) -> DataFrame:
    """The snapshot files below ``root`` in the inclusive date range, one row each:
    ``path, feed, day, table, header, spelled, base``.

    ``tables`` is the allow-list: files named ``<table>.txt``. With ``file_glob`` (say
    ``part-*.csv``) one table whose files have other names can be read. Folders that are
    not dates are ignored. Missing feeds are skipped. Files of no bytes are left out.

    Only names, sizes and the first line that is not blank of each file are read. ``spelled`` is the path
    as Spark's metadata spells it (a blank as ``%20``), ``base`` the length of its part up to the feed folder.
    """
    if file_glob is not None and len(tables) != 1:
        raise ValueError("file_glob names the files of exactly one table")
    pattern = _path_pattern(root)
    spelled = F.col("_metadata.file_path")
    path = _decoded(spelled)
    feed = F.regexp_extract(path, pattern, 2)
    day = snapshot_day(F.regexp_extract(path, pattern, 3))
    wanted = day.isNotNull()
    if feeds is not None:
        wanted &= feed.isin(list(feeds))
    if first_day is not None:
        wanted &= day >= F.lit(str(first_day)).cast("date")
    if last_day is not None:
        wanted &= day <= F.lit(str(last_day)).cast("date")
    table = F.lit(tables[0]) if file_glob else F.regexp_extract(path, r"([^/]+)\.txt$", 1)
    # the spelled path has as many slashes as the plain one
    above = F.size(F.split(F.regexp_extract(path, pattern, 1), "/")) - 1
    base = F.length(F.array_join(F.slice(F.split(spelled, "/"), F.lit(1), above), "/")) + 1
    described = [path.alias("path"), feed.alias("feed"), day.alias("day"), table.alias("table"), spelled.alias("spelled"), base.alias("base")]
    # binaryFile opens no file without its content column
    listed = _tree(spark, "binaryFile", tables, file_glob).load(root)
    found = with_headers(listed.filter(wanted & (F.col("length") > 0)).select(*described))
    return found.select("path", "feed", "day", "table", "header", "spelled", "base")


def _tree(spark: SparkSession, fmt: str, tables: Sequence[str], file_glob: str | None) -> DataFrameReader:
    names = file_glob or "{" + ",".join(f"{t}.txt" for t in tables) + "}"
    return spark.read.format(fmt).options(recursiveFileLookup=True, pathGlobFilter=names)


def discover(
    spark: SparkSession,
    root: str,
    tables: Sequence[str],
    feeds: Sequence[str] | None = None,
    first_day: date | str | None = None,
    last_day: date | str | None = None,
    file_glob: str | None = None,
) -> list[SnapshotFile]:
    """The :func:`manifest` as a sorted list in the driver, for trees of a size to look at.

    A file of blank lines is an error."""
    found = manifest(spark, root, tables, feeds, first_day, last_day, file_glob)
    _check_headers(found)
    files = [SnapshotFile(*row) for row in found.select("path", "feed", "day", "table", "header").collect()]
    return sorted(files, key=lambda f: (f.table, f.feed, f.day, f.path))


def _check_headers(files: DataFrame) -> None:
    blank = sorted(row["path"] for row in files.filter("header IS NULL").select("path").limit(3).collect())
    if blank:
        raise ValueError(f"no header line in {', '.join(blank)}")


def with_headers(files: DataFrame) -> DataFrame:
    """``files`` (with a ``path``) and the first line of each that is not blank, as ``header``.

    Tasks open the files and read them block by block up to the end of that line, whatever its
    length and that of the file. Blank is what Spark's CSV reader skips before a header: nothing
    but white space and control characters. NULL for a file without such a line.
    """
    block = HEADER_BLOCK

    def first_line(file) -> str | None:
        rest, end = b"", False
        while not end:
            got = file.read(block)
            end = not got
            lines = re.split(rb"\r\n|\r|\n", rest + got)
            rest = b"" if end else lines.pop()
            for line in lines:
                text = line.decode("utf-8", "replace")
                if text.strip("".join(map(chr, range(33))) + "\ufeff"):
                    return text
        return None

    def read(batches):
        stores: dict[str, tuple] = {}
        for batch in batches:
            headers = []
            for path in batch.column("path").to_pylist():
                scheme, authority, name = re.fullmatch(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(/.*)", path).groups()
                place = f"{scheme or 'file'}://{authority or ''}/"
                if place not in stores:
                    stores[place] = fs.FileSystem.from_uri(place)
                store, base = stores[place]
                with store.open_input_stream(base.rstrip("/") + name, compression=None) as file:
                    headers.append(first_line(file))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(headers, pa.string())], names=[*batch.schema.names, "header"]
            )

    schema = StructType([*files.schema.fields, StructField("header", StringType())])
    return files.mapInArrow(read, schema)


def column_names(header: str) -> tuple[str, ...]:
    """Names in a header line: no byte-order mark, no outer blanks, lower case.

    Blank and repeated names are numbered by position, as Spark's reader does.
    """
    fields = next(csv.reader([header.lstrip("﻿")]), [])
    names: list[str] = []
    for i, field in enumerate(fields):
        name = field.strip().lower() or f"_c{i}"
        names.append(f"{name}{i}" if name in names else name)
    return tuple(names)


def _stored(files: DataFrame, path: str | None) -> DataFrame:
    """The manifest written once, so that headers are read once: to ``path``, else into the checkpoint folder.

    Where there is neither, each of the few readers of the manifest lists the tree again."""
    spark = files.sparkSession
    if path is None:
        shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not shared:
            return files
        path = f"{shared.rstrip('/')}/stoploom/manifest-{uuid.uuid4().hex}"
    files.write.mode("overwrite").parquet(path)
    return spark.read.schema(files.schema).parquet(path)


def _merged(
    spark: SparkSession, root: str, files: DataFrame, table: str, file_glob: str | None, faults: str | None, infer: bool
) -> DataFrame | None:
    """One table of the tree, see :func:`merge_all`."""
    own = files.filter(F.col("table") == table)
    layouts: dict[tuple[str, ...], int] = {}
    numbers = {r["header"]: layouts.setdefault(column_names(r["header"]), len(layouts)) for r in own.select("header").distinct().sort("header").collect()}
    if not layouts:
        return None
    width = max(map(len, layouts))
    columns = sorted({c for names in layouts for c in names if c not in STAMPED})
    schema = StructType([StructField(f"_{i}", StringType()) for i in range(width)])
    if faults is not None:
        schema = schema.add("line", StringType())
    reader = _tree(spark, "csv", [table], file_glob).schema(schema).option("header", True)
    if faults is not None:
        reader = reader.option("columnNameOfCorruptRecord", "line").option("columnPruning", False)
    spelled = F.col("_metadata.file_path")
    rows = reader.load(root).select(
        spelled.alias("spelled"),
        F.array(*[F.col(f"_{i}") for i in range(width)]).alias("fields"),
        *([_seen(width).alias("seen")] if faults is not None else []),
    )
    # files of other feeds and days are not opened: Spark tests conditions on their names before it plans the scan
    folders = own.select("base", F.substring_index(F.expr("substring(spelled, base + 1)"), "/", 1).alias("folder")).distinct().collect()
    days = own.agg(F.min("day").cast("string").alias("first"), F.max("day").cast("string").alias("last")).first()
    folder = F.substring_index(F.substr(spelled, F.lit(folders[0]["base"] + 1)), "/", 1)
    subdir = F.right(F.substring_index(F.substring_index(spelled, "/", -2), "/", 1), F.lit(10))
    rows = rows.filter(folder.isin(sorted(r["folder"] for r in folders)) & subdir.between(days["first"], days["last"]))
    layout = F.element_at(F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair]), F.col("header"))
    stamps = own.select("spelled", F.col("feed").alias("feed_id"), F.col("day").alias("snapshot_date"), layout.alias("layout"))
    joined = rows.join(stamps, "spelled")

    def place(column: str) -> Column:
        """The column's position in the row's file."""
        at = [F.lit(names.index(column) if column in names else None).cast("int") for names in layouts]
        return F.get(F.array(*at), "layout")

    out = joined.select(
        "feed_id", F.col("snapshot_date").cast("string").alias("subdir"), "snapshot_date",
        *([_fault(F.col("seen"), F.get(F.array(*[F.lit(len(n)) for n in layouts]), "layout")).alias(faults)] if faults is not None else []),
        *[F.get("fields", place(c)).alias(c) for c in columns],
    )
    return with_types(out, columns) if infer else out


def _seen(width: int) -> Column:
    """Fields of a row: all where Spark has not marked it. It refuses to read the marks alone, hence the column."""
    marked = F.col("line").isNotNull() | F.col("_0").isNull()
    return F.when(marked, F.coalesce(field_count("line"), F.lit(width))).otherwise(width)


def _fault(seen: Column, width: Column) -> Column:
    return F.when(seen < width, F.lit("short_row")).when(seen > width, F.lit("long_row"))


def merge_snapshots(
    spark: SparkSession,
    root: str,
    table: str,
    feeds: Sequence[str] | None = None,
    first_day: date | str | None = None,
    last_day: date | str | None = None,
    file_glob: str | None = None,
    faults: str | None = None,
    infer: bool = False,
    store: str | None = None,
) -> DataFrame | None:
    """All snapshots of one table below ``root``; None when there are none. See :func:`manifest`, :func:`merge_all`."""
    files = _stored(manifest(spark, root, [table], feeds, first_day, last_day, file_glob), store)
    _check_headers(files)
    return _merged(spark, root, files, table, file_glob, faults, infer)


def merge_all(
    spark: SparkSession,
    root: str,
    tables: Sequence[str],
    feeds: Sequence[str] | None = None,
    first_day: date | str | None = None,
    last_day: date | str | None = None,
    faults: str | None = None,
    infer: bool = False,
    store: str | None = None,
) -> dict[str, DataFrame]:
    """Every table of ``tables`` that has data, merged. The tree is listed once.

    Columns: ``feed_id``, ``subdir``, ``snapshot_date``, then the union of all file columns in sorted order, as
    strings. A column a file lacks is NULL in its rows. ``faults`` names one more column: ``short_row`` or
    ``long_row`` where a row has fewer or more fields than its file's header, else NULL. ``infer`` types
    each column by its values in all files (one more pass), so it has one type whatever the headers.
    ``store``: where the manifest is written; by default into the checkpoint folder.
    """
    files = _stored(manifest(spark, root, tables, feeds, first_day, last_day), store)
    _check_headers(files)
    merged = {t: _merged(spark, root, files, t, None, faults, infer) for t in tables}
    return {t: df for t, df in merged.items() if df is not None}
