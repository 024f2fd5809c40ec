"""The corpus queries that have SQL, against it."""

import compare
import pytest
from pricebasket.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf_dir, name):
    con = compare.connect(sf_dir)
    assert compare.spark_rows(QUERIES[name](spark, sf_dir)) == compare.oracle_rows(con, ORACLES[name])
