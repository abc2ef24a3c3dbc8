"""Every registered query gives what its SQL counterpart gives."""

from __future__ import annotations

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as driver
from catalog.oracles import ORACLES
from catalog.queries import QUERIES



@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = duck_rows(con, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected


def test_entry(spark):
    assert driver.entry(spark).count() > 0
