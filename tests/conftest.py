from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check import session  # noqa: E402
from growthloom.session import configure  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    yield configure(session(os.environ.get("TEST_CPUS", "8")))


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema to a DataFrame."""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)


def rows(df, *cols):
    """Sorted list of tuples."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
