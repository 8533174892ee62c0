from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from scriptorium.session import local_session  # noqa: E402


# Column expressions in test modules need a session when they are imported.
SESSION = local_session(8, shuffle_partitions=4)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture
def column_value(spark):
    """Value of a column expression over one row of named texts."""

    def value(expression, **columns):
        names = list(columns) or ["unused"]
        row = tuple(columns.values()) or ("",)
        schema = ", ".join(f"{n} string" for n in names)
        return spark.createDataFrame([row], schema).select(expression.alias("v")).collect()[0]["v"]

    return value
