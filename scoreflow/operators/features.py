"""B1: the feature store, built from the order star schema.

The reference refers to a feature-engineering job whose script is absent;
only its output contract is known (one row per loan with ``snapshot_date``,
``label_default``, numeric features and the categoricals
``customer_segment``, ``region``, ``occupation``, ``loan_subtype``). We
build it from the test tables, one loan per order:

* ``orders ⋈ customer ⋈ nation ⋈ region`` for the categoricals;
* per-order line totals from ``lineitem``, aggregated *before* the join
  (partial aggregation map-side, one row per order crosses the shuffle),
  then left-joined so orders without lines survive;
* ``label_default`` = 1 when no line of the order was returned (flag ``R``),
  0 when some line was, NULL when the order has no lines.

At scale ``orders``, ``lineitem`` and ``customer`` are all large, so their
joins are shuffle joins planned by Catalyst; AQE splits a skewed customer
key. Only ``nation`` and ``region`` (fixed-size dimensions) are broadcast,
after their size is checked.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.operators.joins import broadcast_if_small

CATEGORICAL_COLUMNS = ("customer_segment", "occupation", "loan_subtype", "region")
LABEL_COLUMN = "label_default"
DATE_COLUMN = "snapshot_date"
ID_COLUMN = "loan_id"

FEATURE_STORE_COLUMNS = (
    ID_COLUMN,
    DATE_COLUMN,
    LABEL_COLUMN,
    "debt_to_income",
    "utilisation_ratio",
    "n_lines",
    *CATEGORICAL_COLUMNS,
)


def order_line_totals(lineitem: DataFrame) -> DataFrame:
    """Per-order aggregates of the lines (hash aggregate, partial + final)."""
    return lineitem.groupBy(F.col("l_orderkey").alias("loan_id")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"),
        F.sum("l_extendedprice").alias("gross_amount"),
        F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("any_returned"),
    )


def build_feature_store(
    orders: DataFrame,
    lineitem: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    region: DataFrame,
    snapshot_from: dt.date | None = None,
    snapshot_to: dt.date | None = None,
) -> DataFrame:
    """One feature row per order. ``snapshot_from`` / ``snapshot_to`` bound
    ``o_orderdate`` (half-open) at the orders scan, for daily builds."""
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    date_type = orders.schema["o_orderdate"].dataType.simpleString()
    if snapshot_from is not None:
        o = o.filter(F.col("o_orderdate") >= F.lit(str(snapshot_from)).cast(date_type))
    if snapshot_to is not None:
        o = o.filter(F.col("o_orderdate") < F.lit(str(snapshot_to)).cast(date_type))

    # nation ⋈ region is a fixed-size dimension: broadcast it once checked.
    geo = broadcast_if_small(
        nation.select("n_nationkey", "n_name", "n_regionkey").join(
            region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey")
        )
    )
    cust = customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment").join(
        geo, F.col("c_nationkey") == F.col("n_nationkey")
    )
    if snapshot_from is not None or snapshot_to is not None:
        # Only the lines of the bounded orders are aggregated and shuffled on.
        lineitem = lineitem.join(o.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    lines = order_line_totals(lineitem)

    joined = (
        o.join(lines, F.col("o_orderkey") == F.col("loan_id"), "left")
        .join(cust, F.col("o_custkey") == F.col("c_custkey"))
    )
    return joined.select(
        F.col("o_orderkey").alias(ID_COLUMN),
        F.col("o_orderdate").cast("date").alias(DATE_COLUMN),
        F.when(F.col("any_returned").isNull(), F.lit(None).cast("int"))
        .when(F.col("any_returned") == 0, F.lit(1))
        .otherwise(F.lit(0))
        .alias(LABEL_COLUMN),
        F.try_divide(F.col("o_totalprice"), F.greatest(F.abs(F.col("c_acctbal")), F.lit(1.0))).alias("debt_to_income"),
        F.try_divide(F.col("discount_amount"), F.col("gross_amount")).alias("utilisation_ratio"),
        F.coalesce(F.col("n_lines"), F.lit(0)).alias("n_lines"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("n_name").alias("occupation"),
        F.col("o_orderpriority").alias("loan_subtype"),
        F.col("r_name").alias("region"),
    )


def feature_store_from_dir(spark, sf_dir: str, **kwargs) -> DataFrame:
    from scoreflow.sources.parquet import load_tables

    t = load_tables(spark, sf_dir, ["orders", "lineitem", "customer", "nation", "region"])
    return build_feature_store(t["orders"], t["lineitem"], t["customer"], t["nation"], t["region"], **kwargs)
