import math

import duckdb
import pytest

from arrayloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(catalog.ORACLES[name])
    columns = [d[0] for d in want.description]
    want = want.fetchall()
    got = catalog.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    got = [tuple(r[c] for c in columns) for r in got.collect()]
    key = lambda rows: sorted((tuple(map(plain, r)) for r in rows), key=repr)
    assert key(got) == key(want)
