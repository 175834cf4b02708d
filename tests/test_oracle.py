"""Every registered query against its DuckDB oracle on sf0.001, plus the
driver's entry smoke check.  (``tests/run_oracle.py`` runs the same gate at
sf0.01.)"""

import pytest

import __spark_entry__ as E
from webcorpus.plans.oracle import ORACLE
from webcorpus.plans.queries import QUERIES
from compare import compare, duck

SF = "/root/testdata/sf0.001"
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["page_id", "text"]
    assert df.count() > 0


def test_every_key_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    problems, ns, nd = compare(QUERIES[key](spark, SF), con, ORACLE[key])
    assert not problems, problems
