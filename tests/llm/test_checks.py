import pytest
from compare import difference

from trackloom.llm.checks import LLM_ORACLES
from trackloom.llm.queries import LLM_QUERIES


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query(spark, con, sf_dir, name):
    assert difference(LLM_QUERIES[name](spark, sf_dir), con, LLM_ORACLES[name]) is None


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in LLM_QUERIES] == list(range(1, 14))
