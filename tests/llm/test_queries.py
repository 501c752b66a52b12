"""The registered queries of this subpackage that have oracle SQL, on the small driver tables."""

import os

import pytest

from airshed.llm import queries
from tools.oracle_check import run_checks

DATA = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not present")
def test_queries_match_their_oracles(spark):
    results = list(run_checks(spark, DATA, only=set(queries.oracle_sql())))
    assert {n: s for n, s, _ in results} == {n: "OK" for n in queries.oracle_sql()}, results


def test_one_query_per_operator():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)] + ["pipeline"]
