"""Every query against its SQL, on the smallest data folder."""

from __future__ import annotations

import pytest
from compare import connect, difference

from __spark_entry__ import entry
from changeloom.oracles import oracle_sql
from changeloom.queries import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert queries().keys() == oracle_sql().keys()


@pytest.mark.parametrize("name", queries())
def test_query(spark, con, name):
    assert difference(queries()[name](spark, FOLDER), con, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
