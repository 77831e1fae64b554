"""Every registered query against its DuckDB oracle on the sf0.001 tables (driver-style compare)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_all_queries_match_oracle(spark):
    from oracle_check import compare
    res = compare(spark, SF, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "rows-only")}
    assert not bad, bad
    from __spark_entry__ import oracle_sql, queries
    assert set(oracle_sql()) <= set(queries())


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["line_segment", "blackout_ratio"]
    assert df.count() == 4
