"""Registered queries beside their SQL."""

import pytest

from compare import compare, oracle
from llm_data import SF, shipped  # noqa: F401
from tickward.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), oracle(SF), ORACLES[name]) is None


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
