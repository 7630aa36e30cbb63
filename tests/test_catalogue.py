import duckdb
import pytest

from stratiform import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in catalogue.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_same_rows_as_duckdb(spark, con, name):
    df = catalogue.queries()[name](spark, SF)
    found = con.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    ours = sorted(repr(tuple(r[c] for c in order)) for r in df.collect())
    theirs = sorted(repr(tuple(r[names.index(c)] for c in order)) for r in found.fetchall())
    assert ours == theirs


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
