"""Run registered queries beside their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def session(cores: str = "8", partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stoploom-checks")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return names, result.fetchall()


def _comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return str(value)


def normalized(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_comparable(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, sf_dir: str, sql: str) -> str | None:
    """None when columns and rows agree, else what differs."""
    names, expected = oracle_rows(sf_dir, sql)
    rows = [tuple(row) for row in df.collect()]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    left, right = normalized(df.columns, rows), normalized(names, expected)
    if left != right:
        only = [r for r in left if r not in set(right)][:3], [r for r in right if r not in set(left)][:3]
        return f"{len(left)} rows vs {len(right)}; only Spark {only[0]}; only SQL {only[1]}"
    return None


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = session()
    failed = 0
    for name in argv[1:] or QUERIES:
        start = time.time()
        df = QUERIES[name](spark, sf_dir)
        problem = differences(df, sf_dir, ORACLE[name]) if name in ORACLE else "no SQL"
        failed += problem is not None
        print(f"{name:32} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
