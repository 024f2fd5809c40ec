"""Every registered query against its SQL oracle."""

import __spark_entry__ as contract
import compare
import pytest
from pricebasket.plans.queries import QUERIES
from pricebasket.session import work_area


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf_dir, con, name):
    with work_area(spark):
        got = compare.spark_rows(contract.queries()[name](spark, sf_dir))
    assert got == compare.oracle_rows(con, contract.oracle_sql()[name])


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns == ["cart_id", "chain", "store_id", "store_name", "store_price", "distance", "min_price_all"]
