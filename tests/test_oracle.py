"""Every registered query against its SQL, on the smallest test set."""

import os
import re

import oracle
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(entry.queries()) >= set(entry.oracle_sql())
    own = {name for name in entry.queries() if name != "pipeline" and not re.match(r"op\d+_", name)}
    assert own <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert oracle.compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
