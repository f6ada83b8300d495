"""Spark queries against their DuckDB oracle SQL on the smallest tables
(a representative subset; tools/oracle_check.py runs them all)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
NAMES = ["road_objects", "road_bidirectional_rank", "ads_with_ga", "load_upsert", "checks_report",
         "box_stats", "kruskal", "pct_rank_top20", "quarter_currency", "zone_speed", "arrival",
         "related_top5", "search", "melt_city", "population_bands", "holding_rate", "stream_upsert",
         "stream_zone_speed", "ads_csv_load", "export_csv"]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    from oracle_check import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _canon(cols, rows):
    """Rows with columns in name order, floats kept for a tolerant compare,
    sorted by a coarse key (floats to 3 places)."""
    from oracle_check import norm
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        vals = [r[i] for i in order]
        key = tuple(f"{v:.3f}" if isinstance(v, float) else norm(v) for v in vals)
        out.append((key, vals))
    return [v for _, v in sorted(out, key=lambda x: x[0])]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    from oracle_check import norm
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    for a, b in zip(_canon(df.columns, srows), _canon(dcols, drows)):
        for x, y in zip(a, b):
            if isinstance(x, float) or isinstance(y, float):
                assert y is not None and x == pytest.approx(float(y), rel=1e-9, abs=2e-6)
            else:
                assert norm(x) == norm(y)


def test_every_oracle_has_its_query_s_columns(spark, duck):
    import __spark_entry__ as E
    queries, wrong = E.queries(), {}
    for name, sql in E.oracle_sql().items():
        if name.startswith("op") and name[2].isdigit():   # those have tests of their own
            continue
        want = sorted(d[0] for d in duck.execute(f"SELECT * FROM ({sql}) AS q LIMIT 0").description)
        if (got := sorted(queries[name](spark, SF).columns)) != want:
            wrong[name] = (got, want)
    assert not wrong
