"""Job inputs derived from the test tables (see FIXTURES.md).

The reference's jobs read a feature store, a customer snapshot, an activity
log, a response log and a payment stream. None ships with it, so each is
derived here from the test tables by Spark, and grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreflow.functions.dates import utc_wall_to_instant
from scoreflow.operators.filters import drop_unlabelled
from scoreflow.operators.sampling import hash_split
from scoreflow.plans.feature_store import feature_store
from scoreflow.plans.params import SEED, SPLIT_WEIGHTS
from scoreflow.sources.parquet import load_table


def labelled_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_unlabelled(feature_store(spark, sf_dir))


def fixed_score_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out labelled loans scored by a fixed rule SQL can reproduce:
    ``score = 1 / n_lines``, ``prediction = 1.0`` when ``n_lines <= 2``."""
    _, test = hash_split(labelled_store(spark, sf_dir), SPLIT_WEIGHTS, SEED)
    return test.select(
        "loan_id",
        "label_default",
        (F.lit(1.0) / F.col("n_lines")).alias("score"),
        F.when(F.col("n_lines") <= 2, F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"),
    )


def customer_snapshot(
    spark: SparkSession,
    sf_dir: str,
    data_dt: str,
    with_orders_only: bool = False,
    orders_before: str | None = None,
) -> DataFrame:
    """One row per customer: latest order time, balance as credit score,
    share of finished (``F``) orders as delinquency risk, tagged ``data_dt``.
    Per-customer order stats are aggregated before the join.
    ``orders_before`` restates the snapshot with an earlier order cut-off."""
    orders = load_table(spark, sf_dir, "orders")
    if orders_before is not None:
        orders = orders.filter(F.col("o_orderdate") < F.lit(orders_before).cast(orders.schema["o_orderdate"].dataType))
    customer = load_table(spark, sf_dir, "customer")
    stats = orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.max("o_orderdate").alias("snapshot_ts"),
        (F.count_if(F.col("o_orderstatus") == "F") / F.count(F.lit(1))).alias("delinquency_risk"),
    )
    base = customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").alias("credit_score"))
    joined = base.join(stats, "customer_id", "inner" if with_orders_only else "left")
    return joined.select(
        "customer_id", "snapshot_ts", "credit_score", "delinquency_risk", F.lit(data_dt).alias("data_dt")
    )


def activity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity log from ``events``: activity = event type; an even
    ``event_id`` is a ``start`` mark, an odd one a ``finish``."""
    events = load_table(spark, sf_dir, "events")
    kind = F.when(F.col("event_id") % 2 == 0, F.lit(" start")).otherwise(F.lit(" finish"))
    return events.select(
        F.concat(F.col("event_type"), kind).alias("activity_name"), F.col("ts").alias("created_date")
    )


def response_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API response log from ``events``: error events got HTTP 500, all
    others 200; ``load_dt`` is the event time (UTC)."""
    events = load_table(spark, sf_dir, "events")
    failed = F.col("event_type") == "error"
    code = F.when(failed, F.lit(500)).otherwise(F.lit(200))
    header = F.struct(
        code.alias("ResponseCode"),
        F.when(failed, F.lit("Internal Server Error")).otherwise(F.lit("OK")).alias("ResponseMessage"),
        F.lit("TH").alias("Language"),
    )
    return events.select(
        F.col("event_id").alias("request_id"),
        "user_id",
        F.when(failed, F.lit("error")).otherwise(F.lit("success")).alias("status"),
        code.alias("status_code"),
        F.to_json(F.struct(header.alias("Header"))).alias("body"),
        "value",
        F.date_format("ts", "yyyyMMdd").alias("data_dt"),
        F.col("ts").alias("load_dt"),
    )


def payment_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-style envelope rows from ``events``: key = user id, value = the
    JSON props, offset = event id, timestamp = event time."""
    events = load_table(spark, sf_dir, "events")
    session_tz = spark.conf.get("spark.sql.session.timeZone")
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit("payments").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        utc_wall_to_instant(F.col("ts"), session_tz).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def stage_envelopes(spark: SparkSession, sf_dir: str, path: str, rows_per_file: int) -> str:
    """Land the envelopes as offset-ordered files of ``rows_per_file`` rows,
    the way a connector would deliver consecutive offset ranges."""
    env = payment_envelopes(spark, sf_dir)
    env.sortWithinPartitions("offset").write.mode("overwrite").option("maxRecordsPerFile", str(rows_per_file)).parquet(path)
    return path
