"""Rows written with exact counts: clean runs, tasks that are run again, lost attempts, failing writes."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stoploom.operators import count_rejects, split_rejects
from stoploom.sinks import write_counted
from stoploom.sinks.counted import CountedWriter


def rules():
    return {"no_number": F.col("n").isNull(), "odd": F.col("n") > 9}


def frame(spark):
    return spark.createDataFrame([(1, "a"), (None, "b"), (-5, "c"), (12, None), (1, "a")], "n int, s string")


def test_rows_and_counts(spark, rows, tmp_path):
    df, notes = frame(spark), {"negative": F.col("n") < 0, "no_text": F.col("s").isNull()}
    target = str(tmp_path / "out")
    for _ in range(2):  # the second replaces the first
        written = write_counted(df.repartition(3), target, rules(), notes)
    accepted, rejected = split_rejects(df, rules())
    assert rows(written.accepted) == rows(accepted) and rows(written.rejected) == rows(rejected)
    assert written.counts.head().asDict() == count_rejects(df, rules(), notes).head().asDict()
    assert os.listdir(tmp_path) == ["out"]


def test_empty_table_and_clashing_names(spark, rows, tmp_path):
    df = frame(spark)
    written = write_counted(df.limit(0), str(tmp_path / "none"), rules())
    assert written.accepted.collect() == written.rejected.collect() == []
    assert written.counts.head().asDict() == {"rows": 0, "no_number": 0, "odd": 0, "accepted": 0}
    clash = df.selectExpr("*", "'x' AS reject_reason", "7 AS note_0", "8 AS Note_1")
    written = write_counted(clash, str(tmp_path / "clash"), rules(), {"was_x": F.col("reject_reason") == "x", "b": F.col("n") == 1})
    assert written.accepted.columns == ["n", "s", "note_0", "Note_1"]
    assert rows(written.rejected.select("n", "note_0", "reject_reason")) == [(None, 7, "no_number"), (12, 7, "odd")]
    assert written.counts.head().asDict() == {"rows": 5, "no_number": 1, "odd": 1, "was_x": 5, "b": 2, "accepted": 3}
    for bad in ({"rows": F.lit(True)}, {"odd": F.lit(True)}):
        with pytest.raises(ValueError):
            write_counted(df, str(tmp_path / "bad"), rules(), bad)


def test_a_failing_write_keeps_the_old_rows(spark, rows, tmp_path):
    target = str(tmp_path / "out")
    before = rows(write_counted(frame(spark), target, rules()).accepted)
    broken = frame(spark).withColumn("m", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        write_counted(broken, target, rules())
    assert rows(spark.read.parquet(f"{target}/accepted")) == before
    assert os.listdir(tmp_path) == ["out"]


def test_attempts_that_are_not_taken(tmp_path):
    """A task that ended, was lost and ran again: two files, one message."""
    staged = tmp_path / "staged"
    for kind in ("accepted", "rejected"):
        (staged / kind).mkdir(parents=True)
    writer = CountedWriter(str(staged), str(tmp_path / "out"), "reason", ["odd"], {})
    batch = pa.RecordBatch.from_pydict({"n": [1, 2, 3], "reason": pa.array([None, "odd", None])})
    writer.write(iter([batch]))  # its message never arrives
    taken = [writer.write(iter([batch])), writer.write(iter([batch, batch])), writer.write(iter([]))]
    assert len(list(staged.glob("accepted/*"))) == 3
    writer.commit(taken)
    assert json.loads((tmp_path / "out/counts/part-00000.json").read_text()) == {"rows": 9, "odd": 3, "accepted": 6}
    assert len(list((tmp_path / "out").glob("accepted/*"))) == len(list((tmp_path / "out").glob("rejected/*"))) == 2
    assert not staged.exists()


RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from stoploom.sinks import write_counted
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()

def first_attempt_fails(batches):
    yield from batches
    if TaskContext.get().partitionId() % 2 and not TaskContext.get().attemptNumber():
        raise RuntimeError("lost")

df = spark.range(0, 4000, 1, 4).mapInArrow(first_attempt_fails, "id long")
written = write_counted(df, sys.argv[1], {"tens": F.col("id") % 10 == 0}, {"small": F.col("id") < 5})
assert written.counts.head().asDict() == {"rows": 4000, "tens": 400, "small": 5, "accepted": 3600}, written.counts.head()
assert written.accepted.distinct().count() == written.accepted.count() == 3600
assert written.rejected.distinct().count() == written.rejected.count() == 400
"""


def test_tasks_that_are_run_again(tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    env = os.environ | {"PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", RETRIED, str(tmp_path / "out")], env=env, cwd=root, capture_output=True, text=True, timeout=200)
    assert done.returncode == 0, done.stderr[-3000:]
    assert "lost" in done.stderr
