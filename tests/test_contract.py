"""Driver contract on the smallest data: entry() runs, and a sample of queries
agrees with its DuckDB oracle (the full set is checked by tools/check_oracle.py)."""

import duckdb
import pytest

import __spark_entry__ as entry
from shelfwise.plans import registry
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, rows_of

SAMPLE = ["X02_bib", "X03_item", "X06_item_message", "X19_hold", "X20_circ_agg", "V02_duplicate_items_in_location_view",
          "V05_branch_30_day_circ_view", "V09_hold_title_view", "V14_two_months_leased_item_view",
          "V18_dup_at_location_view", "V22_circ_agg_branch_view", "Q02_top_holds", "R07_active_holds_by_title",
          "E01_facet_counts"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "sum_price" in df.columns


def test_every_library_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(registry.QUERIES) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in cur.description]
    assert sorted(s_cols) == sorted(d_cols)
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, cur.fetchall())
