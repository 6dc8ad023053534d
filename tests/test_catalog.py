"""Every query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
import catalog
import check

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return check.database(SF_DIR)


def test_every_catalog_query_has_sql():
    assert set(catalog.all_queries()) == set(catalog.all_sql())
    assert set(catalog.all_queries()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(catalog.all_queries()))
def test_query_equals_sql(spark, database, name):
    assert check.compare(spark, database, SF_DIR, name) in (None, "both empty")
    spark.catalog.clearCache()
