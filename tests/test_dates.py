import datetime as dt

import pytest
from pyspark.sql import functions as F

from scoreflow.functions.dates import local_day_bounds, local_day_window, months_back, yyyymmdd_to_iso


def test_reference_window():
    start, end, data_dt = local_day_window("2024-01-05T20:00:00")
    assert start == dt.datetime(2024, 1, 4, 17)
    assert end == dt.datetime(2024, 1, 5, 17)
    assert data_dt == "20240105"


def test_fraction_cut_and_zone_suffix():
    assert local_day_window("2024-01-05T20:00:00.987654") == local_day_window("2024-01-05T20:00:00")
    assert local_day_window("2024-01-05T20:00:00Z") == local_day_window("2024-01-05T20:00:00")
    assert local_day_window("2024-01-06T03:00:00+07:00") == local_day_window("2024-01-05T20:00:00")


def test_exact_local_midnight():
    # 17:00 UTC is 00:00 in Bangkok: the window is the day that just ended.
    start, end, data_dt = local_day_window("2024-01-05T17:00:00")
    assert (start, end, data_dt) == (dt.datetime(2024, 1, 4, 17), dt.datetime(2024, 1, 5, 17), "20240105")
    start, end, _ = local_day_window("2024-01-05T16:59:59")
    assert end == dt.datetime(2024, 1, 4, 17)


def test_dst_zone_day_lengths():
    start, end, _ = local_day_window("2024-03-11T12:00:00", "America/New_York")
    assert end - start == dt.timedelta(hours=23)


def test_column_bounds_match_python(spark):
    triggers = ["2024-01-05 20:00:00", "2024-01-05 17:00:00", "2024-06-30 23:59:59.5", "2024-03-11 12:00:00"]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            df = spark.createDataFrame([(t,) for t in triggers], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
            for zone in ("Asia/Bangkok", "America/New_York"):
                start, end = local_day_bounds(F.col("t"), zone)
                got = df.select(start.alias("s"), end.alias("e")).collect()
                for t, row in zip(triggers, got):
                    s, e, _ = local_day_window(t.replace(" ", "T"), zone)
                    assert (row["s"], row["e"]) == (s, e), (session_zone, zone, t)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_add_months_clamps(spark):
    row = spark.range(1).select(months_back(dt.date(2024, 8, 31), 6).alias("d")).first()
    assert row["d"] == dt.date(2024, 2, 29)


def test_yyyymmdd(spark):
    df = spark.createDataFrame([("20240105",), ("2024-01-05",), (None,)], "d string")
    assert [r[0] for r in df.select(yyyymmdd_to_iso(F.col("d"))).collect()] == ["2024-01-05", None, None]


def test_window_edges_on_rows(spark):
    from scoreflow.plans.export import daily_window

    rows = [
        (1, dt.datetime(2024, 1, 4, 16, 59, 59, 999999)),  # before local midnight
        (2, dt.datetime(2024, 1, 4, 17, 0, 0)),  # 00:00 local: included
        (3, dt.datetime(2024, 1, 5, 16, 59, 59, 999999)),  # last instant: included
        (4, dt.datetime(2024, 1, 5, 17, 0, 0)),  # next local midnight: excluded
    ]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            base = spark.createDataFrame(rows, "id int, load_dt timestamp_ntz")
            # The lake stores UTC: a zoned column holds the same instants.
            text = F.concat(F.date_format("load_dt", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
            zoned = base.select("id", text.cast("timestamp").alias("load_dt"))
            for df in (base, zoned):
                window, data_dt = daily_window(df, "2024-01-05T20:00:00.5")
                assert sorted(r["id"] for r in window.collect()) == [2, 3], (zone, df.schema)
                assert data_dt == "20240105"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dst_fall_back_day_is_25_hours():
    start, end, data_dt = local_day_window("2024-11-04T12:00:00", "America/New_York")
    assert end - start == dt.timedelta(hours=25) and data_dt == "20241103"
