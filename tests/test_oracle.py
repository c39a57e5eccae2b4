"""Every registered query against its SQL on the driver's smallest tables."""

import oracle
import pytest

from __spark_entry__ import entry
from layerframe.workload import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    rows = {r.STATUS: r.STATUS_count for r in entry(spark).collect()}
    assert set(rows) == {"F", "O", "P"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    n, found = oracle.differences(spark, duck, name, QUERIES[name], ORACLE[name], sf_dir)
    assert found == []
    assert n > 0
