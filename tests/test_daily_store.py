"""The feature store kept by the day and compacted into months."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scoreflow.operators.features import feature_store_from_dir
from scoreflow.plans.daily_store import build_days, build_months, compact_months, read_daily_store, vacuum_store
from scoreflow.session import scratch_path
from scoreflow.sinks.manifest import read_manifest


def _same(store, sf_dir, spark, start, end):
    got = store.drop("run_tag", "snapshot_month")
    want = feature_store_from_dir(spark, sf_dir, snapshot_from=start, snapshot_to=end).select(*got.columns)
    # Sums may differ in their last bits between plans.
    flat = lambda df: df.withColumns({c: F.round(c, 6) for c in ("debt_to_income", "utilisation_ratio")})
    assert got.count() == want.count() > 0 and flat(got).exceptAll(flat(want)).count() == 0


def test_days_become_months(spark, sf_small):
    root = scratch_path(spark, "t_days")
    start, end = dt.date(1997, 5, 20), dt.date(1997, 7, 4)
    report = build_days(spark, sf_small, root, start, end, "r1")
    _same(read_daily_store(spark, root), sf_small, spark, start, end)
    assert report.rows == read_daily_store(spark, root).count()
    days = len(read_manifest(spark, root).folders)
    assert days > 10
    # June is not closed before July, July not at all.
    compact_months(spark, root, dt.date(1997, 6, 30))
    kinds = [k.split(":")[0] for k in read_manifest(spark, root).folders]
    assert kinds.count("month") == 1 and kinds.count("day") < days
    compact_months(spark, root, dt.date(1997, 7, 1))
    folders = read_manifest(spark, root).folders
    assert {k for k in folders if k.startswith("month")} == {"month:1997-05-01", "month:1997-06-01"}
    assert all(k >= "day:1997-07-01" for k in folders if k.startswith("day"))
    _same(read_daily_store(spark, root), sf_small, spark, start, end)
    assert len(read_daily_store(spark, root).where("snapshot_date < '1997-07-01'").inputFiles()) < days
    before = read_daily_store(spark, root).count()
    assert vacuum_store(spark, root, keep=1) and read_daily_store(spark, root).count() == before
    assert compact_months(spark, root, dt.date(1997, 7, 1)).folders == folders  # nothing to do


def test_a_day_of_a_compacted_month_is_built_again(spark, sf_small):
    root = scratch_path(spark, "t_rebuilt")
    start, end = dt.date(1997, 5, 1), dt.date(1997, 7, 1)
    day = feature_store_from_dir(spark, sf_small, snapshot_from=start, snapshot_to=end).agg(F.min("snapshot_date")).first()[0]
    build_months(spark, sf_small, root, start, end, "old")
    build_days(spark, sf_small, root, day, day + dt.timedelta(days=1), "new")

    def tags():
        rows = read_daily_store(spark, root).groupBy("run_tag", (F.col("snapshot_date") == F.lit(day)).alias("own")).count().collect()
        return {(r.run_tag, r.own) for r in rows}

    for _ in range(2):
        assert tags() == {("old", False), ("new", True)}
        _same(read_daily_store(spark, root), sf_small, spark, start, end)
        compact_months(spark, root, end)
    assert read_manifest(spark, root).state == {"replaced": []}
    assert len(read_manifest(spark, root).folders) == 2
    with pytest.raises(ValueError, match="first day"):
        build_months(spark, sf_small, root, dt.date(1997, 5, 2), end, "x")


def test_reads_since_a_day_take_the_folders_that_can_hold_it(spark, sf_small):
    root = scratch_path(spark, "t_since")
    build_months(spark, sf_small, root, dt.date(1997, 1, 1), dt.date(1997, 5, 1), "m")
    build_days(spark, sf_small, root, dt.date(1997, 5, 1), dt.date(1997, 5, 10), "d")
    since = dt.date(1997, 4, 15)
    got = read_daily_store(spark, root, since)
    _same(got, sf_small, spark, since, dt.date(1997, 5, 10))
    assert not any("month=1997-0" + m in f for f in got.inputFiles() for m in "123")
    # A day without rows takes its folder out.
    build_days(spark, sf_small, root, dt.date(2030, 1, 1), dt.date(2030, 1, 3), "none")
    _same(read_daily_store(spark, root, since), sf_small, spark, since, dt.date(1997, 5, 10))
    with pytest.raises(ValueError, match="no rows"):
        read_daily_store(spark, scratch_path(spark, "t_empty"))
