"""Every query with SQL gives what DuckDB gives on the same files."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DOMAIN = {n: q for r in entry._REGISTRIES for n, q in r.queries.items()}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(frame):
    def cell(x):
        if pd.isna(x):
            return None
        if isinstance(x, float):
            return round(x, 6) if math.isfinite(x) else str(x)
        return str(x)

    columns = sorted(frame.columns)
    return columns, sorted((tuple(cell(x) for x in row) for row in frame[columns].astype(object).values.tolist()), key=str)


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n in DOMAIN))
def test_matches_sql(spark, duck, name):
    assert plain(DOMAIN[name](spark, SF).toPandas()) == plain(duck.sql(entry.oracle_sql()[name]).df())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_queries_without_sql_run(spark):
    for name in set(DOMAIN) - set(entry.oracle_sql()):
        assert DOMAIN[name](spark, SF).count() > 0


def test_filters_on_keys_reach_the_scan(spark):
    from adit.operators.dedup import latest

    rows = spark.read.parquet(f"{SF}/events.parquet")
    plan = latest(rows, ["user_id"], ["ts", "event_id"]).where("user_id = 5")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,5)" in plan


def test_calibration_reaches_the_spacing_of_long_tunnels(spark):
    large = "/root/testdata/sf0.1"  # smaller ones have no neighbours so far apart
    near, window = (DOMAIN[n](spark, large).toPandas() for n in ("join_calib_neighbors", "join_calib_window"))
    assert 1.01 ** window["bin"].max() > 7250 > 1.01 ** near["bin"].max()
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{large}/events.parquet'")
    assert plain(window) == plain(connection.sql(entry.oracle_sql()["join_calib_window"]).df())
