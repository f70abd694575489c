"""Queries with a SQL twin, on the smallest tables."""

import math
import pathlib

import duckdb
import pytest

from corpusmill.llm.queries import ORACLES, QUERIES

SF = pathlib.Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not here")


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if v is None or isinstance(v, (bool, str)):
            return v
        return None if isinstance(v, float) and math.isnan(v) else float(v) + 0.0
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    df = QUERIES[name](spark, str(SF))
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.collect(), df.columns) == canonical(result.fetchall(), names)
