"""Every query that has SQL gives the SQL's rows on the smallest tables."""

import os

import duckdb
import pytest

from tidemark.plans.oracles import ORACLES
from tidemark.plans.queries import QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in os.listdir(DIR):
        c.execute(f"create view {t.removesuffix('.parquet')} as select * from '{DIR}/{t}'")
    return c


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(map(tuple, frame.astype(object).where(frame.notna(), None).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert rows(QUERIES[name](spark, DIR).toPandas()) == rows(con.sql(ORACLES[name]).df())
