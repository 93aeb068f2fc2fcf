"""Every registered query against its DuckDB oracle on sf0.001 (rows, columns, values)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

duckdb = pytest.importorskip("duckdb")

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _digest(cols, rows):
    from tools.check_oracles import digest
    return digest(cols, rows)[0]


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(df.columns, srows) == _digest(ocols, orows)


def test_every_catalog_query_has_oracle():
    from strata.plans.catalog import QUERIES
    assert set(QUERIES) - set(entry.oracle_sql()) == entry.NO_ORACLE


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["page_sk", "page_key", "link_pos", "href", "link_text", "page_hash5"]
    assert df.count() > 0
