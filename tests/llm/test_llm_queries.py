import __spark_entry__ as entry
import pytest
from check import compare, connect

from quillwork.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    verdict, _ = compare(spark, connect(sf_dir), name, sf_dir)
    assert verdict.startswith("equal"), verdict


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
