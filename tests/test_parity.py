"""Every registered query of the library equals its DuckDB oracle on the smallest scale."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from parity import TABLES, duck_type, rows_key  # noqa: E402

SF = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _names():
    from chanlytics.plans.catalog import QUERIES

    return sorted(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E

    df = E.queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no oracle")
    res = con.execute(sql)
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    spark_types = {f.name: duck_type(str(f.dataType)) for f in df.schema.fields}
    duck_types = {c[0]: str(c[1]) for c in res.description}
    assert spark_types == duck_types
    assert len(rows) == len(drows)
    assert rows_key(cols, rows) == rows_key(dcols, drows)
