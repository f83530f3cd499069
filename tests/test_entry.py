"""Driver contract smoke test on the smallest table set."""

import os

import pytest

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="test tables not present")
def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
