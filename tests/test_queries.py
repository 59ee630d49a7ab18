import os

import duckdb
import pytest

from comarca import queries, source_queries  # noqa: F401

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(v):
    if hasattr(v, "asDict"):
        v = list(v)
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    frame = queries.QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    if name not in queries.ORACLES:
        assert frame.columns
        return
    found = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    want = sorted((tuple(plain(row[names.index(c)]) for c in columns) for row in found.fetchall()), key=repr)
    assert sorted(names) == columns and got == want
