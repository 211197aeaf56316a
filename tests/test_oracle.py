"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_all_queries_match_oracle(spark):
    import check_oracle
    assert check_oracle.main(SF, []) == 0


def test_entry_smoke(spark):
    import __spark_entry__ as ent
    df = ent.entry(spark)
    assert df.count() >= 0 and df.columns[:2] == ["user_id", "week_start"]
    assert set(ent.oracle_sql()) <= set(ent.queries())
