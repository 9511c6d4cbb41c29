import pytest
from oracle import compare

from kilovela.plans import data_problems, lakehouse, operations, serving

MODULES = (data_problems, lakehouse, operations, serving)
ALL = {k: q for m in MODULES for k, q in m.QUERIES.items()}
SQL = {k: q for m in MODULES for k, q in m.ORACLES.items()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_oracle(spark, name):
    compare(spark, ALL[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(ALL) - set(SQL)))
def test_query_without_oracle_runs(spark, name):
    df = ALL[name](spark, "/root/testdata/sf0.001").toPandas()
    assert len(df) and df.notna().any().all()
