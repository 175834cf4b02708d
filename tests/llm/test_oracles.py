"""Every operator's query on the smallest tables: against SQL where there is some, else whole and typed."""

import pytest

from compare import compare, duck
from webcorpus.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(Q.ORACLE))
def test_query_matches_sql(spark, key):
    problems, *_ = compare(Q.QUERIES[key](spark, SF), duck(SF), Q.ORACLE[key])
    assert not problems, problems


@pytest.mark.parametrize("key", sorted(set(Q.QUERIES) - set(Q.ORACLE) - {"op9_packing"}))
def test_query_covers_every_document(spark, key):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    got = Q.QUERIES[key](spark, SF)
    assert got.count() == n and got.select("doc_id").distinct().count() == n


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in Q.QUERIES) == list(range(1, 14))
