import subprocess
import sys

import pytest

import __spark_entry__ as entry
from check_queries import compare, connect
from shelfwatch.plans.catalog import QUERIES
from shelfwatch.plans.oracles import ORACLES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def tables():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("missing", ["public_tokenizers", "numpy", "xxhash", "shelfwatch.llm"])
def test_entry_without_an_optional_package(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=entry.__file__.rsplit("/", 1)[0])
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], done.stderr


def test_flagship(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 28 and df.count() == 6000


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, tables, name):
    assert compare(spark, tables, name, SMALL).startswith("ok")


@pytest.mark.parametrize(
    "name", ["price_fact", "join_store", "scd2_late", "scd2_as_of", "scd2_apply", "coverage_missing", "new_files_anti"]
)
def test_query_equals_sql_when_nothing_is_broadcast(spark, tables, monkeypatch, name):
    monkeypatch.setattr("shelfwatch.operators.lookup.BROADCAST_BYTES", -1)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        assert compare(spark, tables, name, SMALL).startswith("ok")
    finally:
        spark.conf.set(limit, before)
