"""Every query of the registry against its DuckDB formulation (driver-style
compare); those of the corpus operators are tested in ``tests/llm``."""

import pytest

import __spark_entry__ as E
from candlewick.plans.registry import QUERIES
from oracle_compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    assert name in E.oracle_sql()
    assert compare(spark, SF, [name], verbose=False)[name] is True


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "pattern_type" in df.columns
