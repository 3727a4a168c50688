"""The driver contract: entry(), queries() and their DuckDB oracles agree at sf0.001."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

NO_ORACLE = {n for n in entry.queries() if n.startswith("op") or n == "pipeline"}  # tested in tests/llm


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF_SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["signup_week", "adopted_feature", "week_number", "active_users", "cohort_size",
                          "retention_rate_pct"]


def test_every_query_has_an_oracle_or_is_a_model():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(q) - set(o) == NO_ORACLE - set(o)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in sdf.columns]
    srows = Counter(tuple(_norm(x) for x in r) for r in sdf.collect())
    drows = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert srows == drows


def test_queries_from_threads_share_one_materialisation(spark):
    from concurrent.futures import ThreadPoolExecutor
    fresh = SF_SMALL + "/."  # same data, a new (session, folder) key: nothing materialised yet
    names = ["sessions", "feature_adoption", "user_week_retention", "retention_curve", "impact_summary"]
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda n: Counter(map(tuple, entry.queries()[n](spark, fresh).collect())), names))
    for n, rows in zip(names, got):
        assert rows == Counter(map(tuple, entry.queries()[n](spark, SF_SMALL).collect())), n
