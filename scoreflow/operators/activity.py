"""Activity completion from a start/finish log.

An activity is complete on a day when its latest ``'<name> start'`` and its
latest ``'<name> finish'`` both exist that day and the finish is strictly
later. Names match case-insensitively.

The reference builds one subquery per activity (N scans of the log, names
pasted into SQL) and UNIONs them. Here the log is scanned once: the day is a
range filter on the timestamp (pushed to the scan), each row's name is
split into (activity, start|finish), one grouped aggregate takes both
maxima per activity (partial aggregation, so even an activity holding a
third of the log costs one row per task in the shuffle), and the activity
list — data, not SQL text — is left-joined so an activity without rows
still reports 0.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreflow.functions.dates import ts_literal


def activity_list(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "activity_name string")


def day_filter(log: DataFrame, day: dt.date | None, ts_col: str) -> DataFrame:
    """Rows of ``day`` (default: today) as a half-open range on the
    timestamp, so Parquet sees ``>=`` / ``<`` pushed filters."""
    if day is None:
        return log.filter(F.to_date(F.col(ts_col)) == F.current_date())
    start = dt.datetime.combine(day, dt.time())
    dtype = log.schema[ts_col].dataType
    return log.filter(
        (F.col(ts_col) >= ts_literal(start, dtype)) & (F.col(ts_col) < ts_literal(start + dt.timedelta(days=1), dtype))
    )


def latest_marks(log: DataFrame, day: dt.date | None, name_col: str = "activity_name", ts_col: str = "created_date") -> DataFrame:
    """Per activity key (lower-cased name): latest start and latest finish."""
    lname = F.lower(F.col(name_col))
    is_start, is_finish = lname.endswith(" start"), lname.endswith(" finish")
    parsed = (
        day_filter(log.select(name_col, ts_col), day, ts_col)
        .filter(is_start | is_finish)
        .select(
            F.when(is_start, F.left(lname, F.length(lname) - 6))
            .otherwise(F.left(lname, F.length(lname) - 7))
            .alias("activity_key"),
            F.when(is_start, F.lit("start")).otherwise(F.lit("finish")).alias("kind"),
            F.col(ts_col).alias("ts"),
        )
    )
    return parsed.groupBy("activity_key").agg(
        F.max(F.when(F.col("kind") == "start", F.col("ts"))).alias("latest_start"),
        F.max(F.when(F.col("kind") == "finish", F.col("ts"))).alias("latest_finish"),
    )


def activity_completion(
    log: DataFrame,
    activities: DataFrame,
    day: dt.date | None = None,
    name_col: str = "activity_name",
    ts_col: str = "created_date",
) -> DataFrame:
    """One row per activity of ``activities`` (column ``activity_name``):
    ``activity_name, latest_start, latest_finish, is_completed``."""
    marks = latest_marks(log, day, name_col, ts_col)
    acts = activities.select("activity_name", F.lower("activity_name").alias("activity_key"))
    joined = acts.join(marks, "activity_key", "left")
    done = (
        F.col("latest_start").isNotNull()
        & F.col("latest_finish").isNotNull()
        & (F.col("latest_finish") > F.col("latest_start"))
    )
    return joined.select(
        "activity_name", "latest_start", "latest_finish", F.when(done, F.lit(1)).otherwise(F.lit(0)).alias("is_completed")
    )


def activity_rollup(completion: DataFrame) -> DataFrame:
    """``total_activities, completed_activities, all_completed``. An empty
    list is 0 of 0 and not complete."""
    total = F.count(F.lit(1))
    done = F.coalesce(F.sum("is_completed"), F.lit(0)).cast("bigint")
    return completion.agg(
        total.alias("total_activities"),
        done.alias("completed_activities"),
        F.when((total > 0) & (total == done), F.lit(1)).otherwise(F.lit(0)).alias("all_completed"),
    )
