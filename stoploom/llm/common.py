"""What the operators share: words, tables, batches and scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: What separates such words; also what ``bytes.split()`` splits at.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Arrow batches end at so many bytes, so that very long texts don't meet by the thousand.
BATCH_BYTES = 4 << 20
#: Rows that the Parquet reader decodes together, and bytes that it reads into one array.
READ_ROWS, READ_BYTES = 128, 256 << 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share: ``spark.checkpoint.dir``, else the
    warehouse (tests set neither; a cluster has both on shared storage)."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    shared = shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str, hashes: Iterable[str] = ()) -> DataFrame:
    """``df`` as a table written once on shared storage: a lost executor costs no recomputation.

    Columns of ``hashes`` hardly repeat; they are written without the dictionaries that a task would build for them."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**{f"parquet.enable.dictionary#{c}": "false" for c in hashes}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Bounds the bytes of an Arrow batch; results don't depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def small_reads(spark: SparkSession) -> None:
    """Bounds the arrays that a scan of whole texts allocates; results don't depend on it.

    Unbounded, Spark decodes 4,096 rows together and a vectored read takes a column of a row group in one array: 10 to
    30 MB for usual texts, far more for long ones. Such arrays need adjoining free regions, so the heap grows for them."""
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))
    spark.conf.set("parquet.hadoop.vectored.io.enabled", "false")
    spark.conf.set("parquet.read.allocation.size", str(READ_BYTES))


def word_list(text: Column) -> Column:
    """The words of a text, as built-in expressions; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """Each text's UTF-8 bytes, one at a time; null reads as empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores behind it where ``df`` has a column of that name."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)
