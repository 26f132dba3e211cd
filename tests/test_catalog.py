"""Every catalogue query against its SQL, at the smallest scale."""

import pytest

import check_catalog
from conftest import SF_SMALL

driver = check_catalog.driver
catalog = check_catalog.catalog


@pytest.fixture(scope="module")
def con():
    return check_catalog.connect(SF_SMALL)


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) <= set(driver.queries())
    assert set(catalog.QUERIES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert check_catalog.compare(spark, con, name, SF_SMALL) is None


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.columns[:3] == ["asset", "date", "total_volume"]
    assert frame.count() == 150
