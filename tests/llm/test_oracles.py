"""Registered queries against their SQL texts, on whole tables."""

import pytest

from tabulint.llm import ORACLES, QUERIES
from tests.oracle import assert_same, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(llm, sf_small, name):
    assert assert_same(QUERIES[name](llm, sf_small), connect(sf_small), ORACLES[name]) > 0
