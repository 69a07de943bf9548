"""Every registered query against its SQL on the smallest driver tables."""

import os

import oracle
import pytest

from streamlab.catalogue import all_oracles, all_queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_equals_sql(spark, con, name):
    assert oracle.differences(all_queries()[name](spark, SF), con, all_oracles()[name]) == []


def test_every_query_has_sql():
    assert set(all_oracles()) == set(all_queries())


def test_caller_session_is_left_alone(spark):
    before = spark.conf.getAll
    all_queries()["vote_champion"](spark, SF).collect()
    assert spark.conf.getAll == before
