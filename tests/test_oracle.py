"""Every registered query against its SQL, on whole tables; and again with uneven keys and no broadcasts."""

import pytest

from verification import oracles
from verification import queries as registry
from verification.compare import database, differences

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return database(SF)


def test_every_query_has_its_sql():
    assert set(registry.queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert differences(registry.queries()[name](spark, SF), connection, oracles.oracle_sql()[name]) is None
