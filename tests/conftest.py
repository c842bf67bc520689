import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logloom.session import local_session  # noqa: E402
from logloom.sources.tables import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "4g", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="logloom-")


@pytest.fixture
def warehouse(spark, folder):
    return Warehouse(spark, f"{folder}/warehouse")


@pytest.fixture
def rows():
    """Collect a DataFrame as a sorted list of dictionaries."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((r.asDict(recursive=True) for r in df.collect()), key=str)

    return collect
