"""Every registered query against its SQL at the smallest scale."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_point  # noqa: E402
from tools.check_oracles import TABLES, compare  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(spark, con, name):
    rows, verdict = compare(spark, con, SF, name, entry_point.queries()[name],
                            entry_point.oracle_sql().get(name))
    assert verdict in ("ok", "rows-only"), verdict


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0 and "residual" in df.columns
