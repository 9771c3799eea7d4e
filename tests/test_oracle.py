"""Every registered query against its SQL, on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None


def test_entry_fills_something(spark):
    df = entry.entry(spark)
    assert df.where("equipment_type_similarity_score is not null").count() > 0
