import datetime as dt

from scoreflow.operators.activity import activity_completion, activity_list, activity_rollup
from scoreflow.plans.completion import check_activity_completion

DAY = dt.date(2024, 1, 15)


def _log(spark, rows):
    return spark.createDataFrame(
        [(n, dt.datetime.fromisoformat(t)) for n, t in rows], "activity_name string, created_date timestamp_ntz"
    )


def test_cases(spark):
    log = _log(
        spark,
        [
            ("load start", "2024-01-15 01:00:00"),
            ("load finish", "2024-01-15 02:00:00"),
            ("Tie START", "2024-01-15 03:00:00"),
            ("tie finish", "2024-01-15 03:00:00"),
            ("onlystart start", "2024-01-15 04:00:00"),
            ("onlyfinish finish", "2024-01-15 04:00:00"),
            ("late start", "2024-01-15 05:00:00"),
            ("late finish", "2024-01-16 00:00:00"),  # other day
            ("Mixed Start", "2024-01-15 06:00:00"),
            ("MIXED finish", "2024-01-15 07:00:00"),
            ("load start", "2024-01-15 09:00:00"),  # latest start after finish
            ("load finish", "2024-01-15 10:00:00"),
        ],
    )
    names = ["load", "tie", "onlystart", "onlyfinish", "late", "mixed", "absent"]
    rows = {r["activity_name"]: r for r in activity_completion(log, activity_list(spark, names), DAY).collect()}
    assert rows["load"]["is_completed"] == 1
    assert rows["tie"]["is_completed"] == 0
    assert rows["onlystart"]["is_completed"] == 0
    assert rows["onlyfinish"]["is_completed"] == 0
    assert rows["late"]["is_completed"] == 0
    assert rows["mixed"]["is_completed"] == 1
    assert rows["absent"]["is_completed"] == 0 and rows["absent"]["latest_start"] is None
    roll = activity_rollup(activity_completion(log, activity_list(spark, names), DAY)).first()
    assert (roll["total_activities"], roll["completed_activities"], roll["all_completed"]) == (7, 2, 0)

    gate = check_activity_completion(spark, log, names, DAY)
    assert gate["completed"] == ["load", "mixed"]
    assert not gate["all_completed"]
    assert check_activity_completion(spark, log, ["load"], DAY)["all_completed"]


def test_empty_list_is_not_complete(spark):
    log = _log(spark, [("a start", "2024-01-15 01:00:00")])
    empty = spark.createDataFrame([], "activity_name string")
    roll = activity_rollup(activity_completion(log, empty, DAY)).first()
    assert (roll["total_activities"], roll["completed_activities"], roll["all_completed"]) == (0, 0, 0)
    assert check_activity_completion(spark, log, [], DAY)["all_completed"] is False


def test_day_filter_is_pushed(spark, sf_small):
    from scoreflow.plans.fixtures import activity_log

    plan = activity_completion(activity_log(spark, sf_small), activity_list(spark, ["click"]), DAY)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text
