"""Small tables for the text operators."""

from __future__ import annotations

import pytest

from scriptorium.session import local_session

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def docs(spark):
    """Builds a documents table with a clashing extra column from (doc_id, text) pairs."""

    def build(rows):
        return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")

    return build
