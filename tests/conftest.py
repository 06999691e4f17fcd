import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

from tallyforge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, "4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def make(spark):
    """make(schema, *rows) -> DataFrame"""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)
