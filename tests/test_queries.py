"""Every query of the reference's own operators against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import strandforge.queries as q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return repr(v)


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect(config={"memory_limit": "3GB", "temp_directory": ""})
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_query(spark, small, duck, name):
    df = q.QUERIES[name](spark, small)
    rows, columns = df.collect(), sorted(df.columns)
    assert rows or name in ("join_window_near_iter",)
    if name in q.SQL:
        found = duck.execute(q.SQL[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        want = sorted(str([plain(dict(zip(names, r))[c]) for c in columns]) for r in found.fetchall())
        assert sorted(str([plain(r[c]) for c in columns]) for r in rows) == want
