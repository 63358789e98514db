"""Physical-plan properties that matter at scale: filters reach the scan,
scans read only the needed columns, and no data-sized stage funnels into a
single partition."""

import pytest

import __spark_entry__ as entry
from scoreflow.plans.export import daily_window
from scoreflow.plans.fixtures import response_log


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "feature_store_build",
        "scan_recent_labelled",
        "train_test_split",
        "stringify_columns",
        "activity_completion",
        "response_log_normalise",
        "category_index",
        "confusion_matrix",
    ],
)
def test_no_single_partition_exchange(spark, sf_small, name):
    plan = _plan(entry.queries()[name](spark, sf_small))
    assert "SinglePartition" not in plan, plan


def test_recency_pushdown_and_pruning(spark, sf_small):
    plan = _plan(entry.queries()["scan_recent_labelled"](spark, sf_small))
    assert "PushedFilters: [IsNotNull(snapshot_date), GreaterThanOrEqual(snapshot_date,2001-02-01)]" in plan
    assert "ReadSchema: struct<snapshot_date:date,label_default:int,customer_segment:string>" in plan
    # Month folders before the cut-off are pruned.
    assert "PartitionFilters: [isnotnull(snapshot_month" in plan and "(snapshot_month#" in plan


def test_export_window_pushdown(spark, sf_small):
    window, data_dt = daily_window(response_log(spark, sf_small), "2024-01-05T20:00:00")
    plan = _plan(window)
    assert data_dt == "20240105"
    assert "GreaterThanOrEqual(ts,2024-01-04T17:00)" in plan and "LessThan(ts,2024-01-05T17:00)" in plan


def test_feature_store_aggregates_lines_before_join(spark, sf_small):
    plan = _plan(entry.queries()["feature_store_build"](spark, sf_small))
    assert "partial_count(1)" in plan and "partial_max(" in plan
    # Line totals are a per-order hash aggregate, joined afterwards.
    agg_at = plan.index("HashAggregate(keys=[l_orderkey")
    assert plan.index("Join") < agg_at


def test_rebalance_orders_only_the_cut_bucket(spark, sf_small):
    import re

    from scoreflow.operators.sampling import FINAL_ROWS

    plan = _plan(entry.queries()["rebalance_negatives"](spark, sf_small))
    limits = [int(x) for x in re.findall(r"TakeOrderedAndProject\(limit=(\d+)", plan)]
    assert all(n <= FINAL_ROWS for n in limits), limits
    assert not re.search(r"Sort \[[^\]]*\], true", plan)  # no global sort of the negatives
