"""Every registered query against its SQL oracle, on the smallest test tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry
from borderlake.verification.oracle import oracle
from borderlake.verification.queries import REGISTERED
from compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(REGISTERED) == set(oracle())


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_matches_oracle(spark, con, name):
    assert difference(REGISTERED[name](spark, SF_DIR), con, oracle()[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
