"""Queries that SQL can express equal their SQL on whole tables."""

import pytest

from loanweave.llm.catalog import ORACLES, QUERIES
from loanweave.plans.checking import compare


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    outcome = compare(spark, "/root/testdata/sf0.001", QUERIES[name], ORACLES[name])
    assert outcome.startswith("ok"), outcome
