"""Registered queries over small tables of their own, against their SQL in DuckDB."""

import datetime as dt

import pytest


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Events of five days (half of them of small magnitude), with the tables that the other feeds come from."""
    d = str(tmp_path_factory.mktemp("tables"))
    kinds = ("view", "click", "purchase", "signup", "error")
    start = dt.datetime(2024, 1, 12, 5, 0, 0)
    events = [(i, start + dt.timedelta(hours=i // 2), i % 4, kinds[i % 5], float(i % 2) + i / 50, "{}") for i in range(240)]
    frames = {
        "events": (events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
        "customer": ([(i, f"Customer {i}", i % 3, 0.0, "M") for i in range(1, 41)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": ([(i, f"N{i}", 0) for i in range(3)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(i, f"Supplier {i}", i % 3, 0.0) for i in range(1, 9)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


def _both(spark, d, name):
    import duckdb

    import __spark_entry__ as E

    con = duckdb.connect()
    for t in ("events", "customer", "nation", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet/*.parquet')")
    found, want = E.queries()[name](spark, d), con.execute(E.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert found.columns == columns
    return sorted(map(tuple, found.collect()), key=str), sorted(want.fetchall(), key=str)


def test_replay_brings_back_every_day_and_magnitude(spark, tables):
    found, want = _both(spark, tables, "replay_equals_fresh")
    assert found == want
    assert len({r[2].date() for r in found}) >= 5 and min(r[0] for r in found) < 2.0
