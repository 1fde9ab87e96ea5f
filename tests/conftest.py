import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(cores="4", partitions=4)
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return spark


@pytest.fixture
def rows():
    """Sorted result rows as tuples, NULL first."""

    def collect(df):
        found = [tuple(r) for r in df.collect()]
        return sorted(found, key=lambda r: [(v is not None, str(v)) for v in r])

    return collect
