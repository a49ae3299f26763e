"""Every registered query against its SQL."""

import oracle
import pytest

import __spark_entry__ as entry
from dimweave.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_registry():
    assert set(QUERIES) == set(entry.ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["event_id", "enriched"]
    assert frame.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    rows, difference = oracle.compare(con, QUERIES[name](spark, SF), entry.ORACLES[name])
    assert difference is None
    # A thousand orders of one status are more than the smallest tables have.
    assert rows > 0 or name == "sample_every_n"
