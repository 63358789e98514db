"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver does the same at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from scoreflow import registry
from scoreflow.sources.parquet import TEST_TABLES
from tools.check_oracle import compare

# The corpus operators have tests of their own.
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TEST_TABLES:
        path = f"{sf_small}/{t}.parquet"
        if os.path.exists(path):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_every_query_has_oracle_or_is_ml():
    rows_only = set(registry.QUERIES) - set(registry.ORACLE)
    assert rows_only == set()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, sf_small, name):
    res = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), sf_small)
    assert res["rows"] >= 0
    if name in entry.oracle_sql():
        assert res["cols_match"], res
        assert res["rows"] == res["oracle_rows"], res
        assert res["values_match"], res
        assert not res["type_diffs"], res


def test_entry_returns_metrics_row(spark):
    df = entry.entry(spark)
    assert df.columns == ["run_tag", "precision", "recall", "auc"]
    rows = df.collect()
    assert len(rows) == 1
    assert 0.0 <= rows[0]["auc"] <= 1.0


@pytest.mark.parametrize("name", ["daily_window_export", "bronze_stream", "activity_completion", "stringify_columns"])
def test_results_do_not_depend_on_session_time_zone(spark, con, sf_small, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        res = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], sf_small)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert res["values_match"] and not res["type_diffs"], res
