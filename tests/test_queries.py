"""Every registered survey query against its DuckDB twin on the smallest tables; the entry points."""

import os
import shutil

import duckdb
import pytest

import __spark_entry__ as entry
from nightloom.plans import registry

SF = "/root/testdata/sf0.001"
QUERIES, TWINS = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    return round(v, 9) + 0.0 if isinstance(v, float) else v


def rows_of(names, columns, rows):
    at = [columns.index(n) for n in names]
    return sorted((tuple(repr(plain(r[k])) for k in at) for r in rows))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name in TWINS:
        cur = duck.execute(TWINS[name])
        columns = [d[0] for d in cur.description]
        assert sorted(columns) == sorted(df.columns)
        names = sorted(columns)
        assert rows_of(names, df.columns, rows) == rows_of(names, columns, cur.fetchall())
    assert rows or name in FEW  # no row on either side would say nothing


#: Kinds of objects that the smallest tables are too small to have.
FEW = {"u14_named_known"}


def test_links_beyond_the_first_objects(spark):
    """All 2,000 objects of this table, not only the first 400."""
    sf = SF.replace("0.001", "0.01")
    ids = [x[0] for x in duckdb.sql(f"SELECT p_partkey FROM '{sf}/part.parquet'").fetchall()]
    assert max(ids) > 400
    got = sorted(x.ids for x in QUERIES["j9_link_tracklets_all"](spark, sf).collect())
    assert got == sorted(f"{k * 10},{k * 10 + 3},{k * 10 + 6}" for k in ids)


@pytest.mark.parametrize("name", ["j7_evaluate_tracklets", "j12_lsd_tracklets"])
def test_objects_that_share_places(spark, tmp_path, name):
    """As at larger sizes: three objects a place on the same nights, two of them with the same motion."""
    for f in os.listdir(SF):
        shutil.copyfile(f"{SF}/{f}", tmp_path / f)
    duckdb.sql(f"COPY (SELECT CAST(k + 20172 * m AS BIGINT) AS p_partkey FROM range(40) a(k), (VALUES (0), (5), (35)) b(m)) TO '{tmp_path}/part.parquet'")
    c = duckdb.connect()
    for f in os.listdir(tmp_path):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{tmp_path}/{f}'")
    df = QUERIES[name](spark, str(tmp_path))
    cur = c.execute(TWINS[name])
    columns = [d[0] for d in cur.description]
    assert rows_of(columns, df.columns, df.collect()) == rows_of(columns, columns, cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
