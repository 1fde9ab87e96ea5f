"""Sinks. All of them overwrite their target."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

#: Rows that the console shows at most.
CONSOLE_ROWS = 1000
#: Stores that tasks open with Arrow's file systems.
ARROW_STORES = ("file", "hdfs", "s3", "gs", "abfs", "abfss")
_COPIED = 1 << 22


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("feed_id", "snapshot_date"),
    only_touched: bool = False,
) -> None:
    """Parquet below ``path`` in one folder per value of ``by``.

    Rows are gathered by folder first, so a folder gets few files; the rebalance hint lets
    Spark cut a large folder over several tasks and put small ones together.
    With ``only_touched`` folders that receive no rows stay as they are.
    """
    writer = df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by)
    if only_touched:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Headered CSV files below ``path``.

    With ``one_file`` there is a single file, which suits reports: all tasks write parts in parallel, one
    task then joins their bytes in the order of the rows, and the file takes the place of what ``path``
    held. ``path`` keeps its old content if anything before that fails.
    """
    if one_file:
        _write_joined(df, path)
    else:
        df.write.mode("overwrite").option("header", True).csv(path)


def _write_joined(df: DataFrame, path: str) -> None:
    spark = df.sparkSession
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path.rstrip("/"))
    store = target.getFileSystem(conf)
    target = store.makeQualified(target)
    if store.getUri().getScheme() not in ARROW_STORES:  # one task for all rows, where tasks cannot open files
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
        return
    staged = hadoop.Path(f"{target}-parts-{uuid.uuid4().hex}")
    try:
        # the line of names is written as a row, so its quoting is that of the rows
        names = spark.createDataFrame([tuple(df.columns)], ", ".join(f"_{i} string" for i in range(len(df.columns))))
        names.coalesce(1).write.csv(f"{staged}/names")
        df.write.csv(f"{staged}/rows")
        parts = []  # one name a task
        for folder in ("names", "rows"):
            listed = store.globStatus(hadoop.Path(f"{staged}/{folder}/part-*.csv"))
            parts += sorted(f"{status.getPath()}" for status in listed)
        made = _join_parts(spark, parts, f"{staged}/joined")
        if store.exists(target):
            store.delete(target, True)
        store.mkdirs(target)
        store.rename(hadoop.Path(made), hadoop.Path(target, "part-00000.csv"))
        store.create(hadoop.Path(target, "_SUCCESS")).close()
    finally:
        store.delete(staged, True)


def _join_parts(spark: SparkSession, parts: list[str], folder: str) -> str:
    """The bytes of ``parts`` one after another in a new file of ``folder``, copied by one task; a task that is run again
    starts a file of its own."""

    def run(batches):
        for _ in batches:
            pass
        made = f"{folder}/{uuid.uuid4().hex}.csv"
        store, place = fs.FileSystem.from_uri(folder)
        store.create_dir(place)
        with store.open_output_stream(f"{place}/{made.rsplit('/', 1)[1]}", compression=None) as out:
            for part in parts:
                with store.open_input_stream(fs.FileSystem.from_uri(part)[1], compression=None) as file:
                    while data := file.read(_COPIED):
                        out.write(data)
        yield pa.RecordBatch.from_arrays([pa.array([made])], names=["path"])

    return spark.range(1).coalesce(1).mapInArrow(run, "path string").first()["path"]


def save_table_if_db(df: DataFrame, database: str, table: str) -> bool:
    """Save as a catalog table if ``database`` exists; returns whether it did.

    Rows go to a table beside the old one, which is replaced once all of them are written: a write that
    fails leaves the old table as it was."""
    spark = df.sparkSession
    if not spark.catalog.databaseExists(database):
        return False
    staged = f"`{database}`.`{table}_{uuid.uuid4().hex}`"
    try:
        df.write.saveAsTable(staged)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
    spark.sql(f"ALTER TABLE {staged} RENAME TO `{database}`.`{table}`")
    return True


def print_rows(df: DataFrame, most: int = CONSOLE_ROWS) -> None:
    """The first rows as tab-separated text, a header first; if there are more than ``most``, a last line counts them all."""
    print("\t".join(df.columns))
    found = df.limit(most + 1).collect()
    for row in found[:most]:
        print("\t".join("" if value is None else str(value) for value in row))
    if len(found) > most:
        print(f"({most} of {df.count()} rows; name a database or an output path for all of them)")


def publish(df: DataFrame, table: str, database: str | None = None, path: str | None = None, one_file: bool = True) -> DataFrame:
    """Save ``df`` whole as a table of ``database`` or as CSV below ``path``, or print its first rows.

    ``one_file`` is for reports; row-level results keep a file a task. Both targets are written if both are
    given. A database that does not exist is an error without ``path``. Returns ``df``.
    """
    saved = database is not None and save_table_if_db(df, database, table)
    if path is not None:
        write_csv(df, path, one_file)
    elif database is not None and not saved:
        raise ValueError(f"there is no database {database!r}; name one that exists or an output path")
    elif not saved:
        print_rows(df)
    return df
