import duckdb
import pytest

import __spark_entry__ as entry
from quarrylink.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_sql(spark, sf, duck, name):
    got = catalogue.QUERIES[name](spark, sf).toPandas()
    assert len(got)
    if name in catalogue.ORACLES:
        want = duck.execute(catalogue.ORACLES[name]).fetchdf()
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        rows = lambda df: df[columns].astype(str).sort_values(columns, ignore_index=True)
        assert rows(got).equals(rows(want))


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
