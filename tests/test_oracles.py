"""Every query that SQL can express equals its SQL on the smallest tables."""

import pytest

from loanweave.plans.catalog import ORACLES, QUERIES
from loanweave.plans.checking import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    outcome = compare(spark, SF, QUERIES[name], ORACLES[name])
    assert outcome.startswith("ok"), outcome


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
