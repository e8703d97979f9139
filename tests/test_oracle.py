"""Every registered query against its oracle SQL on the smallest data set."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import check, oracle

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, duck, name):
    assert check(spark, duck, name, queries()[name], oracle_sql()[name], SF_DIR) == ""


def test_entry(spark):
    assert entry(spark).count() > 0
