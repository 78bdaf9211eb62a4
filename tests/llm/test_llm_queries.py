"""Every query of this part at the smallest size, against its SQL where there is one."""

import pytest
from oracle_check import connect, differences

from touchline.llm.queries import LLM_ORACLES, LLM_QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(LLM_ORACLES))
def test_equals_sql(spark, key):
    assert differences(LLM_QUERIES[key](spark, FOLDER), connect(FOLDER), LLM_ORACLES[key]) == []


#: Their own tests hold their rows against brute force.
OTHER_ROWS = {"op11_prefix_trie", "op13_whitening"}


@pytest.mark.parametrize("key", sorted(set(LLM_QUERIES) - set(LLM_ORACLES) - OTHER_ROWS))
def test_gives_a_row_per_row(spark, key):
    read = "pages" if key.startswith("op3") else "documents"
    expected = spark.read.parquet(f"{FOLDER}/{read}.parquet").count()
    result = LLM_QUERIES[key](spark, FOLDER)
    assert result.count() >= expected
    assert key.startswith("op5") or result.count() == expected


def test_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {f"{k.split('_')[0]}_" for k in names}
    assert "pipeline" in names
