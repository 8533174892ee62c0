"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    ok, note = compare(spark, con, FOLDER, name, queries()[name], oracle_sql().get(name))
    assert ok, note


def test_split_is_consistent_with_the_distance(spark):
    rows = queries()["udf01_split_of_unrelated_texts"](spark, FOLDER)
    assert rows.filter("NOT consistent OR fidelity_distance + scope_insertion_distance <> distance").count() == 0


def test_split_of_odd_texts(spark, tmp_path):
    texts = [None, "", "#", "##", "#a", "a", "aa", "....", "a" * 400, "§", "§§§", "§a", "a§a", "¶", "¶¶", "a¶", "§¶", "#¶§", "Ä. ", " ", "ab" * 300]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    name = "udf01_edit_script_split"
    ok, note = compare(spark, con, str(tmp_path), name, queries()[name], oracle_sql()[name], verbose=True)
    assert ok, note
