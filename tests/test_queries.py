"""Every query of the engine that has SQL gives the same rows as DuckDB on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest
from pvscan.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("nation", "customer", "part", "orders", "lineitem", "events", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = df.collect()
    if name not in ORACLE_SQL:
        assert got
        return
    want = duck.sql(ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert Counter(tuple(plain(r[c]) for c in columns) for r in got) == Counter(tuple(plain(r[i]) for i in at) for r in want.fetchall())


@pytest.mark.parametrize("name", ["roi_windows", "roi_windows_screen"])
def test_windows_of_far_boxes(spark, tmp_path, name):
    """Boxes of high keys lie millions of metres down; their windows are in the result like others."""
    con = duckdb.connect()
    keys = "select unnest([1, 2, 524260, 524300, 600000, 1200000, 9000000]) as k"
    con.sql(f"copy (select k as p_partkey, cast(40 + k % 10 as integer) as p_size from ({keys})) to '{tmp_path}/part.parquet'")
    con.sql(f"copy (select k as c_custkey, cast(k % 25 as integer) as c_nationkey from ({keys})) to '{tmp_path}/customer.parquet'")
    for t in ("part", "customer"):
        con.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
    got = sorted((r.row, r.col) for r in QUERIES[name](spark, str(tmp_path)).collect())
    assert got == sorted(con.sql(f"select row, col from ({ORACLE_SQL[name]}) q").fetchall())
    assert got[-1][0] > 17_000_000


@pytest.mark.parametrize("name", ["chip_cut", "chip_pack"])
def test_no_exploded_table_is_broadcast(spark, name):
    """A small file of boxes is millions of pixels: no plan sends them through the driver for its size on disk."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    lines = [(len(x) - len(x.lstrip(" :+-")), x) for x in plan.splitlines() if x.strip()]
    broadcast = []
    for i, (depth, x) in enumerate(lines):
        if "BroadcastHashJoin" in x:
            end = next((k for k in range(i + 1, len(lines)) if lines[k][0] <= depth), len(lines))
            kids = [k for k in range(i + 1, end) if lines[k][0] == lines[i + 1][0]]
            broadcast += lines[kids[0] : kids[1]] if "BuildLeft" in x else lines[kids[1] : end]
    assert "SortMergeJoin" in plan and not any("Generate" in x for _, x in broadcast)
