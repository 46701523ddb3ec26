import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from quarryline.plans import catalogue


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(t)[:-8]} AS SELECT * FROM '{t}'")
    return con


def texts(rows):
    return sorted(tuple(str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    rows = catalogue.QUERIES[name](spark, sf_dir)
    columns = sorted(rows.columns)
    found = duck.sql(catalogue.ORACLES[name])
    assert sorted(found.columns) == columns
    assert texts(rows.select(*columns).collect()) == texts(found.select(*[f'"{c}"' for c in columns]).fetchall())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["month", "brand", "lines", "quantity", "gross", "net"]
    assert rows.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
