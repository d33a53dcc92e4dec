"""Every query equals its DuckDB oracle."""

import pytest

from reachmap.plans.catalog import QUERIES
from reachmap.plans.oracles import oracles

from .compare import connect, difference

ORACLES = oracles()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None
