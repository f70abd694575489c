"""Every registered query against its SQL twin on the smallest tables."""

import math
import pathlib
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = pathlib.Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
OWN = {n: sql for n, sql in entry.oracle_sql().items() if not re.match(r"op\d+_|pipeline$", n)}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if v is None or isinstance(v, (bool, str)):
            return v
        return None if isinstance(v, float) and math.isnan(v) else float(v) + 0.0
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, str(SF))
    result = duck.execute(OWN[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.collect(), df.columns) == canonical(result.fetchall(), names)


# Values of fitted models, which test_learn.py checks against a brute-force fit.
FITTED = {"train_report", "al_rounds", "al_picks", "uncertainty_values", "curation_report", "fused_report"}


def test_every_query_has_sql():
    assert {n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)} == set(OWN) | FITTED


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
