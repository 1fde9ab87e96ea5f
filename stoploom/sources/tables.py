"""Reading merged tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stoploom.functions.text import field_count, trim_all
from stoploom.operators.typing import with_types


def read_csv_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ",",
    infer: bool = False,
    trim: bool = False,
    faults: str | None = None,
) -> DataFrame:
    """Headered CSV files that share one header; ``paths`` may hold wild-cards.

    All columns are strings unless ``infer`` is set, which costs one more pass over the data.
    Quoted commas are part of the field, empty fields and missing trailing fields are NULL.
    For files whose headers differ use :func:`stoploom.sources.merge_snapshots`.

    ``faults`` names one more column: ``short_row`` or ``long_row`` where a line has fewer or more fields than
    the header, else NULL. Spark marks such lines while it parses them, so only theirs are counted.
    """
    where = list(paths) if not isinstance(paths, str) else paths
    reader = spark.read.option("header", True).option("sep", sep)
    if faults is None:
        table = reader.option("inferSchema", infer).csv(where)
        return trim_all(table) if trim else table
    names = reader.csv(where).columns
    line = f"{'_'.join(names)}_line"  # a name that no column has
    schema = StructType([StructField(n, StringType()) for n in (*names, line)])
    marked = reader.schema(schema).option("columnNameOfCorruptRecord", line).option("columnPruning", False).csv(where)
    seen = field_count(F.col(f"`{line}`"), sep)
    fault = F.when(seen < len(names), F.lit("short_row")).when(seen > len(names), F.lit("long_row"))
    # Spark refuses to read the marked lines alone, so the reason looks at a column, too
    fault = F.when(F.col(f"`{line}`").isNotNull() | F.col(f"`{names[0]}`").isNull(), fault)
    table = marked.select(*[F.col(f"`{n}`") for n in names if n != faults], fault.alias(faults))
    table = trim_all(table) if trim else table
    return with_types(table, [n for n in names if n != faults]) if infer else table


def read_table(spark: SparkSession, dataset: str, table: str, fmt: str = "parquet") -> DataFrame:
    """A merged table below ``dataset``: a Parquet folder, or ``<table>/*.csv``.

    Feed names stay text, also where all of them look like numbers.
    """
    if fmt == "csv":
        return read_csv_table(spark, f"{dataset}/{table}/*.csv")
    found = spark.read.format(fmt).load(f"{dataset}/{table}")
    types = dict(found.dtypes)
    if types.get("feed_id", "string") == "string":
        return found
    fields = [StructField(f.name, StringType()) if f.name == "feed_id" else f for f in found.schema]
    return spark.read.schema(StructType(fields)).format(fmt).load(f"{dataset}/{table}")
