import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("BENCH_PARTITIONS", "3")
    return local_session(8)


@pytest.fixture
def clicks_of(spark):
    """A click table from (prev, curr, type, month, n) rows."""

    def make(rows):
        return spark.createDataFrame(rows, "prev string, curr string, type string, month string, n int")

    return make
