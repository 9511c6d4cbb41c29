import pytest
from oracle import compare

from kilovela.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_oracle(spark, name):
    compare(spark, queries.QUERIES[name], queries.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_without_oracle_runs(spark, name):
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001").toPandas()
    assert len(df) and df.notna().any().all()
