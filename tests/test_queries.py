"""Every registered query against its SQL twin; those of the training-data operators have tests of their own."""

import re

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)))
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, entry.queries()[name], entry.oracle_sql().get(name)) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
