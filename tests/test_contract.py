"""Driver contract: entry runs; every query matches its DuckDB oracle (sf0.001)."""

import os
import subprocess
import sys

import __spark_entry__ as entry
from conftest import SF_SMALL
from haze.plans import catalog

ROWS_ONLY: set = set()


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["canonical_city", "reading_date", "avg_aqi", "max_aqi", "min_aqi",
                          "avg_pm25", "avg_pm10", "dominant_category"]


def test_every_query_has_an_oracle_unless_rows_only():
    assert set(catalog.queries()) - set(entry.oracle_sql()) == ROWS_ONLY
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_match_duckdb_oracle():
    tool = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools", "oracle_check.py")
    res = subprocess.run([sys.executable, tool, SF_SMALL, *catalog.queries()], capture_output=True, text=True, timeout=1500)
    assert res.returncode == 0, res.stdout[-4000:] + res.stderr[-2000:]
    assert "mismatches: 0" in res.stdout
