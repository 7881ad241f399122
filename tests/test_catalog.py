"""Every registered query of the engine against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from runlens.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name not in catalog.ORACLES:
        assert got
        return
    found = duck.execute(catalog.ORACLES[name])
    cols = [d[0] for d in found.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(cols, found.fetchall())


def test_every_query_but_the_model_has_sql():
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == {"logistic_model"}
