import pytest

import __spark_entry__ as entry
from check import compare, connect
from quillwork.workload.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, connection, name):
    verdict, _ = compare(spark, connection, name, sf_dir)
    assert verdict.startswith(("equal", "rows only")), verdict


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and "original_text" in frame.columns


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
