"""The completion gate.

Returns which activities completed today, which are pending, and whether
all did. Unlike the reference (all-or-nothing lists, any error reported as
"all pending"), the lists are per activity and errors propagate. Only the
per-activity result — one row per requested activity — reaches the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from scoreflow.operators.activity import activity_completion, activity_list


def check_activity_completion(
    spark: SparkSession,
    log: DataFrame,
    activity_names: Sequence[str],
    day: dt.date | None = None,
    is_dryrun: bool = False,
) -> dict:
    names = list(activity_names)
    if is_dryrun:
        return {"completed": names, "pending": [], "all_completed": bool(names)}
    if not names:
        return {"completed": [], "pending": [], "all_completed": False}
    rows = activity_completion(log, activity_list(spark, names), day).collect()
    done = {r["activity_name"] for r in rows if r["is_completed"] == 1}
    completed = [n for n in names if n in done]
    pending = [n for n in names if n not in done]
    return {"completed": completed, "pending": pending, "all_completed": not pending}
