"""Hot keys: one key holding a third of all rows must give the same results
and must not be funnelled through one task (partial aggregation first)."""

import datetime as dt

from pyspark.sql import functions as F

from scoreflow.operators.activity import activity_completion, activity_list
from scoreflow.operators.features import build_feature_store
from scoreflow.operators.metrics import auc_exact


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_customer_feature_store(spark, sf_small):
    from scoreflow.sources.parquet import load_tables

    t = load_tables(spark, sf_small, ["orders", "lineitem", "customer", "nation", "region"])
    n = t["orders"].count()
    # A third of all orders move to customer 1.
    hot = t["orders"].withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey"))
    )
    fs = build_feature_store(hot, t["lineitem"], t["customer"], t["nation"], t["region"])
    assert fs.count() == n
    assert fs.join(t["orders"].select(F.col("o_orderkey").alias("loan_id")), "loan_id").count() == n


def test_hot_activity_single_grouped_scan(spark):
    base = dt.datetime(2024, 1, 15, 0, 0)
    rows = [("busy start" if i % 2 == 0 else "busy finish", base + dt.timedelta(seconds=i)) for i in range(3000)]
    rows += [("quiet start", base), ("quiet finish", base + dt.timedelta(hours=1))]
    log = spark.createDataFrame(rows, "activity_name string, created_date timestamp_ntz")
    out = activity_completion(log, activity_list(spark, ["busy", "quiet"]), dt.date(2024, 1, 15))
    got = {r["activity_name"]: r["is_completed"] for r in out.collect()}
    assert got == {"busy": 1, "quiet": 1}
    plan = _plan(out)
    assert "partial_max" in plan  # map-side combine before the shuffle
    assert "Union" not in plan  # one grouped scan, not one subquery per activity


def test_hot_score_auc(spark):
    # A third of the rows share one score.
    rows = [(i, i % 2, 0.5 if i % 3 == 0 else (i % 97) / 97.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "loan_id long, label_default int, score double")
    one = auc_exact(df, "score").first()["auc"]
    many = auc_exact(df, "score", groups_per_range=100).first()["auc"]
    pdf = df.toPandas()
    pos, neg = pdf[pdf.label_default == 1].score.values, pdf[pdf.label_default == 0].score.values
    import numpy as np

    brute = (np.sum(pos[:, None] > neg[None, :]) + 0.5 * np.sum(pos[:, None] == neg[None, :])) / (len(pos) * len(neg))
    assert abs(one - brute) < 1e-12 and abs(many - brute) < 1e-12


def test_hot_day_is_split_across_write_tasks(spark):
    from scoreflow.plans.feature_store import feature_store_layout

    rows = [(i, dt.date(2001, 3, 1) if i % 3 == 0 else dt.date(2001, 1, 1) + dt.timedelta(days=i % 200)) for i in range(6000)]
    df = spark.createDataFrame(rows, "loan_id long, snapshot_date date")
    # At this size AQE would merge all range partitions into one; turn that
    # off to see how the range sampler cut the rows.
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        laid = feature_store_layout(df).withColumn("pid", F.spark_partition_id())
        hot = laid.filter(F.col("snapshot_date") == dt.date(2001, 3, 1))
        assert hot.select("pid").distinct().count() > 1
        assert laid.count() == 6000
    finally:
        spark.conf.set(key, old)
