import glob
import os

import duckdb
import pytest

from broadsheet.llm import queries
from tests.test_queries import value

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        duck.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = queries.QUERIES[name](spark, SF)
    found = duck.sql(queries.ORACLES[name])
    order = sorted(df.columns)
    assert sorted(found.columns) == order
    at = [found.columns.index(c) for c in order]
    got = sorted(tuple(value(x[c]) for c in order) for x in df.collect())
    assert got == sorted(tuple(value(x[i]) for i in at) for x in found.fetchall())
