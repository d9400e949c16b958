"""Every registered query against its SQL in DuckDB, on the smallest check tables."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry
from wardline.plans import oracle, registry

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="check tables not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    db = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def ordered(rows, positions):
    def plain(value):
        return "nan" if isinstance(value, float) and math.isnan(value) else value

    return sorted((tuple(plain(row[i]) for i in positions) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries())
    assert set(oracle.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, duck, name):
    frame = registry.queries()[name](spark, SF_DIR)
    result = duck.execute(oracle.oracle_sql()[name])
    sql_columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(sql_columns)
    names = sorted(sql_columns)
    got = ordered(frame.collect(), [frame.columns.index(c) for c in names])
    want = ordered(result.fetchall(), [sql_columns.index(c) for c in names])
    assert got == want


def test_entry(spark):
    frame = entry.entry(spark)
    assert len(frame.columns) == 30
    assert frame.count() > 0
