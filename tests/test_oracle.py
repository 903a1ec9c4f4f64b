"""Every registered query against its DuckDB oracle (sf0.001 here; the driver uses sf0.01)."""

import os

import pytest

from brandpulse.plans import catalog
from oracle_check import compare

SF = os.environ.get("BRANDPULSE_TEST_SF", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(catalog.REGISTRY))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, SF)
    assert r["status"] in ("ok", "no-oracle"), r


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["sentiment_label", "count", "avg_score", "percentage"]
    assert df.count() >= 0
    assert set(E.oracle_sql()) <= set(E.queries())
