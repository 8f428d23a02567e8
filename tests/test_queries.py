"""Every query that SQL can express against its SQL counterpart on the smallest data set."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(entry_points.oracle_sql()))
def test_query(spark, con, name):
    _, found = differences(entry_points.queries()[name](spark, SF), con, entry_points.oracle_sql()[name])
    assert not found, found


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
