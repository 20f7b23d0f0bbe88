import pytest

import __spark_entry__
from checks.compare import connect, difference
from usagelens.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_against_its_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) is None


def test_all_are_registered():
    assert set(QUERIES) < set(__spark_entry__.queries()) and "pipeline" in __spark_entry__.queries()
    assert [n for i in range(1, 14) for n in QUERIES if n.startswith(f"op{i}_")] == list(QUERIES)
