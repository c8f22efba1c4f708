"""Every registered panel query against its SQL on the same tables."""

import duckdb
import pytest

from tidepanel.queries import oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _rows(table):
    names = sorted(table.column_names)
    frame = table.select(names).to_pandas()
    for c in frame.columns:
        if frame[c].dtype == object:
            frame[c] = frame[c].map(lambda v: None if v is None or v != v else str(v))
    return frame.sort_values(names, ignore_index=True)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    got, want = queries()[name](spark, sf_dir).toArrow(), duck.sql(oracle_sql()[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    a, b = _rows(got), _rows(want)
    assert len(a) == len(b)
    for c in a.columns:
        differs = ~((a[c] == b[c]) | (a[c].isna() & b[c].isna()))
        assert not differs.any(), (c, a[c][differs].head().tolist(), b[c][differs].head().tolist())


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_runs(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).toArrow().column_names
