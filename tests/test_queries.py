"""Every registered query against its SQL on the driver's tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.oracle_check import DATA, connect, difference

SF_DIR = DATA / "sf0.01"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    with connect(SF_DIR) as con:
        yield con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    frame = entry.queries()[name](spark, str(SF_DIR))
    if name in ORACLES:
        assert difference(frame, duck.sql(ORACLES[name])) is None
    else:
        assert frame.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
