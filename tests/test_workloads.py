"""Every registered query against its DuckDB oracle on the sf0.01 tables (the driver's correctness gate)."""

import os

import pytest

import __spark_entry__  # noqa: F401  registers all queries
from airshed import workloads
from tools.oracle_check import run_checks

DATA = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not present")
def test_all_queries_match_oracle(spark):
    results = list(run_checks(spark, DATA, only=set(workloads.queries())))
    failures = [(n, d) for n, s, d in results if s == "FAIL"]
    assert not failures, failures
    assert len(results) >= 65
    assert all(s == "OK" for _, s, _ in results)      # every one has an oracle


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0 and "custom_group" in df.columns
