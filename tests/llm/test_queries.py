import pytest

import __spark_entry__ as entry
from check_queries import compare, connect
from shelfwatch.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL


def test_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SMALL), name, SMALL).startswith("ok")
