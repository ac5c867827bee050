import glob
import math
import os
import re

import duckdb
import pytest

from broadsheet.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, (float,)):
        return repr(round(v, 6) + 0.0)
    return re.sub(r" 00:00:00$", "", str(v))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows, cols = df.collect(), df.columns
    if name not in ORACLES:
        assert rows
        return
    r = duck.sql(ORACLES[name])
    assert sorted(cols) == sorted(r.columns)
    order = sorted(cols)
    at = [r.columns.index(c) for c in order]
    got = sorted(tuple(value(x[c]) for c in order) for x in rows)
    assert got == sorted(tuple(value(x[i]) for i in at) for x in r.fetchall())
