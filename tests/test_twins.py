"""Every query beside its DuckDB twin on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from laddermill import registry

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return str(v)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_twin(spark, con, name):
    got = registry.QUERIES[name](spark, SF)
    rows = [r.asDict() for r in got.collect()]
    if name not in registry.ORACLE:
        assert got.columns
        return
    want = con.sql(registry.ORACLE[name])
    assert sorted(want.columns) == sorted(got.columns)
    columns = sorted(got.columns)
    ours = sorted(str([plain(r[c]) for c in columns]) for r in rows)
    theirs = sorted(str([plain(r[want.columns.index(c)]) for c in columns]) for r in want.fetchall())
    assert ours == theirs
