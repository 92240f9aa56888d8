"""Every registered query equals its SQL oracle, value for value."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidewell.catalogue import QUERIES as OWN
from tests.compare import differences, oracle_connection

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF)


def test_every_query_has_an_oracle():
    """Only what SQL cannot express goes without, and only outside the catalogue."""
    assert set(OWN) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, ORACLE[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
