"""Every registered query against its comparison SQL on the smallest tables."""

import pytest
from compare import difference, duck
from conftest import SF

import __spark_entry__
from ruleframe.workloads.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, name, SF) is None


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns[0] == "order_key"
    assert df.count() == 6000
