"""The registered queries: SQL where there is any, and one for each operator."""

import re

import pytest

import __spark_entry__ as entry
from oracle import differences, duck
from quarryline.llm.queries import ORACLES, QUERIES


def test_one_query_for_each_operator():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(name, spark, folder):
    with duck(folder) as con:
        assert differences(QUERIES[name](spark, folder), con, ORACLES[name]) is None
