"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_all_queries_match_oracle(spark):
    import __spark_entry__ as se
    from oracle_harness import compare
    res = compare(spark, SF, sorted(se.oracle_sql()))
    bad = {k: v for k, v in res.items() if not v["match"]}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as se
    df = se.entry(spark)
    assert "snapshot_date" in df.columns and df.count() > 0
    assert set(se.oracle_sql()) <= set(se.queries())
