"""Every registered job equals its DuckDB oracle on the smallest test tables."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL
from ledgerline.catalog import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
NAMES = sorted(QUERIES)


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("d", str(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return ("t", v.isoformat())
    return (type(v).__name__, repr(v))


def _rows(table):
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    return cols, sorted(tuple(_norm(x) for x in row) for row in zip(*data))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def _arrow(rel):
    out = rel.to_arrow_table() if hasattr(rel, "to_arrow_table") else rel.arrow()
    return out.read_all() if hasattr(out, "read_all") else out


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SMALL).toArrow()
    want = _arrow(duck.sql(entry.oracle_sql()[name]))
    assert _rows(got) == _rows(want)
    got_types = {f.name: str(f.type).replace("large_", "") for f in got.schema}
    want_types = {f.name: str(f.type).replace("large_", "") for f in want.schema}
    assert got_types == want_types


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["sales_agent", "manager", "regional_office", "won_deals", "lost_deals", "win_rate_pct",
                          "avg_cycle_days", "total_bookings", "bookings_rank"]
    assert df.count() > 0
