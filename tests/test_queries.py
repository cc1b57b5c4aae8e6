import math
import os

import duckdb
import pytest

from evidra.plans import catalogue

DIR = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        path = f"{DIR}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(round(r[i], 6) if isinstance(r[i], float) and not math.isnan(r[i]) else r[i] for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DIR)
    got = plain(df.collect(), df.columns)
    assert got
    res = duck.execute(catalogue.ORACLE_SQL[name])
    columns = [c[0] for c in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == plain(res.fetchall(), columns)
