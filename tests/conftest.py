import datetime as dt
import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwatch.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "6g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def day(n: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def stamp(n: int, hour: int = 3) -> dt.datetime:
    return dt.datetime.combine(day(n), dt.time(hour))


def rows(df, *columns):
    """Rows as sorted tuples, for comparison without an order."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)
