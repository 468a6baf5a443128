"""Driver contract: entry runs, every query has a callable, a sample matches DuckDB."""

import duckdb

import __spark_entry__ as E
from conftest import SF_SMALL
from tidemark.sources.tables import SOURCE_TABLES


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert len(rows) >= 1
    years = [r.enrol_year for r in rows]
    assert years == sorted(years) and all(r.enrol_month <= 12 for r in rows)


def test_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90


def test_sample_against_duckdb(spark):
    import sys
    import os

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
    from check_oracle import rows_of

    con = duckdb.connect()
    for t in SOURCE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ("a04_yearly_snapshot_totals", "b02_opportunity_scores", "b08_occupation_view", "p02_header_detection"):
        sdf = E.queries()[name](spark, SF_SMALL)
        cur = con.execute(E.oracle_sql()[name])
        dcols = [d[0] for d in cur.description]
        assert sorted(sdf.columns) == sorted(dcols), name
        assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(dcols, cur.fetchall()), name
