"""The registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame``
per operator group, and the DuckDB SQL that must give the same rows.

Every query reads the test tables of ``sf_dir`` (or tables Spark derives
from them) in full. Doubles that come out of sums or ratios are rounded to
6 decimals on both sides so that summation order cannot change the hash.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreflow.functions.dates import instant_to_utc_wall
from scoreflow.functions.textify import to_text_columns
from scoreflow.operators.activity import activity_completion, activity_rollup
from scoreflow.operators.features import CATEGORICAL_COLUMNS, feature_store_from_dir
from scoreflow.operators.filters import drop_unlabelled, filter_recent
from scoreflow.operators.metrics import auc_exact, classification_metrics, confusion_matrix
from scoreflow.operators.ml import build_feature_pipeline, category_indexer, index_column
from scoreflow.operators.profile import feature_columns_profile
from scoreflow.operators.responses import normalise_responses
from scoreflow.operators.sampling import rebalance, split_label
from scoreflow.plans.daily_store import build_days, build_months, compact_months, read_daily_store, vacuum_store
from scoreflow.plans.export import daily_export, read_export
from scoreflow.plans.feature_store import FEATURE_TABLES, feature_job, feature_store, materialize_feature_store, source_key
from scoreflow.plans.fixtures import (
    activity_log,
    customer_snapshot,
    fixed_score_predictions,
    labelled_store,
    payment_envelopes,
    response_log,
    stage_envelopes,
)
from scoreflow.plans.loads import frame_to_lake
from scoreflow.plans.training import TrainingConfig, score_with, split_recent, train_and_score, training_run
from scoreflow.session import app_key, scratch_path
from scoreflow.sinks.artifacts import load_model, read_metrics, save_model, write_metrics
from scoreflow.sinks.lake import read_date_partitioned
from scoreflow.sources.parquet import load_table, read_feature_store, read_merged
from scoreflow.sources.sql_files import packaged_sql, run_sql_file
from scoreflow.sources.tables import table_scan
from scoreflow.streaming.bronze import envelope_file_source, start_bronze
from scoreflow.streaming.bronze_store import compact, read_bronze_store, start_bronze_store, vacuum

# Fixed parameters of the registered queries.
from scoreflow.plans.params import (  # noqa: I001
    ACTIVITY_DAY,
    AS_OF,
    EXPORT_TRIGGER,
    EXPORT_ZONE,
    SAMPLING_RATIO,
    SEED,
    SPLIT_WEIGHTS,
    WINDOW_MONTHS,
)

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return wrap


def r6(column) -> F.Column:
    return F.round(column, 6)


# --------------------------------------------------------------------------
# Shared oracle fragments (DuckDB)
# --------------------------------------------------------------------------

FEATURE_STORE_SQL = """
lines AS (
    SELECT l_orderkey AS loan_id,
           count(*) AS n_lines,
           sum(l_extendedprice * l_discount) AS discount_amount,
           sum(l_extendedprice) AS gross_amount,
           max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS any_returned
    FROM lineitem GROUP BY l_orderkey
),
fs AS (
    SELECT o.o_orderkey AS loan_id,
           CAST(o.o_orderdate AS DATE) AS snapshot_date,
           CAST(CASE WHEN l.any_returned IS NULL THEN NULL
                     WHEN l.any_returned = 0 THEN 1 ELSE 0 END AS INTEGER) AS label_default,
           o.o_totalprice / greatest(abs(c.c_acctbal), 1.0) AS debt_to_income,
           l.discount_amount / nullif(l.gross_amount, 0) AS utilisation_ratio,
           coalesce(l.n_lines, 0) AS n_lines,
           c.c_mktsegment AS customer_segment,
           n.n_name AS occupation,
           o.o_orderpriority AS loan_subtype,
           r.r_name AS region
    FROM orders o
    LEFT JOIN lines l ON o.o_orderkey = l.loan_id
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


def _md5_unit_sql(key: str) -> str:
    return f"CAST(CAST('0x' || substr(md5('{SEED}|' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE"


def _md5_order_sql(key: str) -> str:
    return f"CAST('0x' || substr(md5('{SEED}|' || CAST({key} AS VARCHAR)), 1, 15) AS BIGINT)"


LABELLED_SQL = f"""
labelled AS (SELECT * FROM fs WHERE label_default IS NOT NULL),
split AS (
    SELECT *, CASE WHEN {_md5_unit_sql('loan_id')} < {SPLIT_WEIGHTS[0]}::DOUBLE THEN 'train' ELSE 'test' END AS part
    FROM labelled
),
pred AS (
    SELECT loan_id, label_default, 1.0::DOUBLE / n_lines AS score,
           CASE WHEN n_lines <= 2 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
    FROM split WHERE part = 'test'
)"""

RECENT_SQL = f"""
recent AS (
    SELECT * FROM fs
    WHERE snapshot_date >= CAST(DATE '{AS_OF}' - INTERVAL {WINDOW_MONTHS} MONTH AS DATE)
      AND label_default IS NOT NULL
)"""


# --------------------------------------------------------------------------
# 1. Feature store, recency scan, profile
# --------------------------------------------------------------------------


@register(
    "feature_store_build",
    f"""
WITH {FEATURE_STORE_SQL}
SELECT loan_id, snapshot_date, label_default,
       round(debt_to_income, 6) AS debt_to_income,
       round(utilisation_ratio, 6) AS utilisation_ratio,
       n_lines, customer_segment, occupation, loan_subtype, region
FROM fs
""",
)
def q_feature_store_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = feature_store_from_dir(spark, sf_dir)
    return fs.withColumn("debt_to_income", r6(F.col("debt_to_income"))).withColumn(
        "utilisation_ratio", r6(F.col("utilisation_ratio"))
    )


@register(
    "feature_store_written",
    f"""
WITH {FEATURE_STORE_SQL}
SELECT loan_id, snapshot_date, label_default,
       round(debt_to_income, 6) AS debt_to_income,
       round(utilisation_ratio, 6) AS utilisation_ratio,
       n_lines, customer_segment, occupation, loan_subtype, region,
       CAST(date_trunc('month', snapshot_date) AS DATE) AS snapshot_month, 'query' AS run_tag
FROM fs
""",
)
def q_feature_store_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 as a job: the month-partitioned feature table written by
    ``feature_job`` and read back (S1), partition column included."""
    path = scratch_path(spark, "feature_job")
    feature_job(spark, sf_dir, path, run_tag="query")
    fs = read_feature_store(spark, path)
    return fs.withColumn("debt_to_income", r6(F.col("debt_to_income"))).withColumn(
        "utilisation_ratio", r6(F.col("utilisation_ratio"))
    )


FEATURE_DAYS = (dt.date(1997, 6, 11), dt.date(1998, 3, 4))


@register(
    "feature_store_daily",
    f"""
WITH {FEATURE_STORE_SQL}
SELECT loan_id, snapshot_date, label_default,
       round(debt_to_income, 6) AS debt_to_income,
       round(utilisation_ratio, 6) AS utilisation_ratio,
       n_lines, customer_segment, occupation, loan_subtype, region,
       CASE WHEN snapshot_date = DATE '{FEATURE_DAYS[0]}' THEN 'rebuilt' ELSE 'first' END AS run_tag
FROM fs WHERE snapshot_date IN (DATE '{FEATURE_DAYS[0]}', DATE '{FEATURE_DAYS[1]}')
""",
)
def q_feature_store_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 day by day: two days built apart and one built again."""
    path = scratch_path(spark, "feature_days")
    for day, run_tag in ((FEATURE_DAYS[0], "first"), (FEATURE_DAYS[1], "first"), (FEATURE_DAYS[0], "rebuilt")):
        feature_job(spark, sf_dir, path, run_tag, day)
    fs = read_feature_store(spark, path)
    return fs.withColumn("debt_to_income", r6(F.col("debt_to_income"))).withColumn(
        "utilisation_ratio", r6(F.col("utilisation_ratio"))
    )


# Built as months, then by the day; the day of a compacted month is built again.
DAYS_FROM, DAYS_TO, REBUILT_DAY = dt.date(2001, 6, 1), dt.date(2001, 8, 2), FEATURE_DAYS[1]


@register(
    "feature_store_compacted",
    f"""
WITH {FEATURE_STORE_SQL}
SELECT loan_id, snapshot_date, label_default,
       round(debt_to_income, 6) AS debt_to_income,
       round(utilisation_ratio, 6) AS utilisation_ratio,
       n_lines, customer_segment, occupation, loan_subtype, region,
       CASE WHEN snapshot_date = DATE '{REBUILT_DAY}' THEN 'rebuilt' WHEN snapshot_date >= DATE '{DAYS_FROM}' THEN 'daily'
            ELSE 'history' END AS run_tag
FROM fs
""",
)
def q_feature_store_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 as a store kept by the day: history as months, two months as days,
    one old day built again, all closed months compacted, and old folders
    removed. Equals the one-shot build."""
    root = scratch_path(spark, "daily_store")
    build_months(spark, sf_dir, root, dt.date(1990, 1, 1), DAYS_FROM, "history")
    build_days(spark, sf_dir, root, DAYS_FROM, DAYS_TO, "daily")
    build_days(spark, sf_dir, root, REBUILT_DAY, REBUILT_DAY + dt.timedelta(days=1), "rebuilt")
    compact_months(spark, root, DAYS_TO)
    vacuum_store(spark, root, keep=1)
    fs = read_daily_store(spark, root)
    return fs.withColumn("debt_to_income", r6(F.col("debt_to_income"))).withColumn(
        "utilisation_ratio", r6(F.col("utilisation_ratio"))
    )


@register(
    "scan_recent_labelled",
    f"""
WITH {FEATURE_STORE_SQL}, {RECENT_SQL}
SELECT customer_segment,
       count(*) AS n_rows,
       CAST(sum(label_default) AS BIGINT) AS n_positive,
       round(avg(label_default), 6) AS positive_rate
FROM recent
GROUP BY customer_segment
""",
)
def q_scan_recent_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = drop_unlabelled(filter_recent(feature_store(spark, sf_dir), WINDOW_MONTHS, as_of=AS_OF))
    return recent.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("label_default").alias("n_positive"),
        r6(F.avg("label_default")).alias("positive_rate"),
    )


@register(
    "feature_columns_profile",
    f"""
WITH {FEATURE_STORE_SQL}
SELECT 'debt_to_income' AS feature, count(debt_to_income) AS non_null,
       round(min(debt_to_income), 6) AS min_value, round(max(debt_to_income), 6) AS max_value FROM fs
UNION ALL
SELECT 'utilisation_ratio', count(utilisation_ratio),
       round(min(utilisation_ratio), 6), round(max(utilisation_ratio), 6) FROM fs
UNION ALL
SELECT 'n_lines', count(n_lines), round(min(n_lines), 6), round(max(n_lines), 6) FROM fs
""",
)
def q_feature_columns_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = feature_columns_profile(feature_store(spark, sf_dir))
    return prof.select("feature", "non_null", r6(F.col("min_value")).alias("min_value"), r6(F.col("max_value")).alias("max_value"))



# --------------------------------------------------------------------------
# 2. Split, rebalance, metrics on fixed-rule predictions
# --------------------------------------------------------------------------


@register(
    "train_test_split",
    f"""
WITH {FEATURE_STORE_SQL}
SELECT loan_id, label_default,
       CASE WHEN {_md5_unit_sql('loan_id')} < {SPLIT_WEIGHTS[0]}::DOUBLE THEN 'train' ELSE 'test' END AS part
FROM fs
""",
)
def q_train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    fs = feature_store(spark, sf_dir)
    return fs.select("loan_id", "label_default", split_label(SPLIT_WEIGHTS, ("train", "test"), SEED).alias("part"))


@register(
    "rebalance_negatives",
    f"""
WITH {FEATURE_STORE_SQL}, {LABELLED_SQL},
pos AS (SELECT loan_id, label_default FROM labelled WHERE label_default = 1),
neg AS (
    SELECT loan_id, label_default,
           row_number() OVER (ORDER BY {_md5_order_sql('loan_id')}, loan_id) AS rn
    FROM labelled WHERE label_default = 0
)
SELECT loan_id, label_default FROM pos
UNION ALL
SELECT loan_id, label_default FROM neg
WHERE rn <= (SELECT CAST(floor({SAMPLING_RATIO} * count(*)) AS BIGINT) FROM pos)
""",
)
def q_rebalance_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rebalance(
        # No bucket is small enough to be ordered at once: the cut goes down to single rows.
        labelled_store(spark, sf_dir), SAMPLING_RATIO, seed=SEED, final_rows=0
    )
    return out.select("loan_id", "label_default")


@register(
    "confusion_matrix",
    f"""
WITH {FEATURE_STORE_SQL}, {LABELLED_SQL}
SELECT label_default, prediction, count(*) AS n FROM pred GROUP BY label_default, prediction
""",
)
def q_confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_matrix(fixed_score_predictions(spark, sf_dir))


AUC_SQL = """
g AS (
    SELECT score,
           sum(CASE WHEN label_default = 1 THEN 1 ELSE 0 END) AS pos,
           sum(CASE WHEN label_default = 0 THEN 1 ELSE 0 END) AS neg
    FROM pred GROUP BY score
),
r AS (
    SELECT pos, neg,
           coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
    FROM g
),
a AS (SELECT sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg))::DOUBLE AS auc FROM r)"""


@register(
    "auc_exact",
    f"""
WITH {FEATURE_STORE_SQL}, {LABELLED_SQL}, {AUC_SQL}
SELECT round(auc, 6) AS auc FROM a
""",
)
def q_auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    auc = auc_exact(fixed_score_predictions(spark, sf_dir), "score")
    return auc.select(r6(F.col("auc")).alias("auc"))


@register(
    "classification_metrics",
    f"""
WITH {FEATURE_STORE_SQL}, {LABELLED_SQL}, {AUC_SQL},
cm AS (
    SELECT count(*) FILTER (WHERE label_default = 1 AND prediction = 1.0) AS tp,
           count(*) FILTER (WHERE label_default = 0 AND prediction = 1.0) AS fp,
           count(*) FILTER (WHERE label_default = 1 AND prediction = 0.0) AS fn
    FROM pred
)
SELECT 'fixed_rule' AS run_tag,
       round(tp / greatest(tp + fp, 1), 6) AS precision,
       round(tp / greatest(tp + fn, 1), 6) AS recall,
       round((SELECT auc FROM a), 6) AS auc
FROM cm
""",
)
def q_classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 through the metrics sink (K6): the row is written as JSON under
    ``<metrics>/<run_tag>`` and read back."""
    m = classification_metrics(fixed_score_predictions(spark, sf_dir), "score", run_tag="fixed_rule")
    target = write_metrics(m, scratch_path(spark, "metrics"), "fixed_rule")
    back = read_metrics(spark, target)
    return back.select("run_tag", *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "auc")])


# --------------------------------------------------------------------------
# 3. ML: indexing, assembly, forest, reload
# --------------------------------------------------------------------------

def _training_config(run_tag: str = "sf_query") -> TrainingConfig:
    return TrainingConfig(
        run_tag=run_tag,
        training_window_months=WINDOW_MONTHS,
        sampling_ratio=SAMPLING_RATIO,
        as_of=AS_OF,
        seed=SEED,
        split_weights=SPLIT_WEIGHTS,
    )


_CATEGORY_LONG_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS value FROM labelled" for c in CATEGORICAL_COLUMNS
)


@register(
    "category_index",
    f"""
WITH {FEATURE_STORE_SQL}, {LABELLED_SQL},
long AS ({_CATEGORY_LONG_SQL}),
c AS (SELECT feature, value, count(*) AS n FROM long GROUP BY feature, value)
SELECT feature, value,
       CAST(row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) - 1 AS DOUBLE) AS idx,
       n
FROM c
""",
)
def q_category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = labelled_store(spark, sf_dir)
    indexed = category_indexer(CATEGORICAL_COLUMNS).fit(lab).transform(lab)
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"), F.col(index_column(c)).alias("idx"))
                for c in CATEGORICAL_COLUMNS
            ]
        )
    ).alias("r")
    return indexed.select(pairs).select("r.*").groupBy("feature", "value", "idx").agg(F.count(F.lit(1)).alias("n"))


_RANKS_SQL = f"""
cat_counts AS (
    SELECT feature, value, count(*) AS n FROM ({_CATEGORY_LONG_SQL}) long GROUP BY feature, value
),
ranks AS (
    SELECT feature, value,
           CAST(row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) - 1 AS DOUBLE) AS idx
    FROM cat_counts
)"""

_ASSEMBLY_JOINS = "\n".join(
    f"JOIN ranks r{i} ON r{i}.feature = '{c}' AND r{i}.value = l.{c}" for i, c in enumerate(CATEGORICAL_COLUMNS)
)
_ASSEMBLY_IDX = ", ".join(f"r{i}.idx AS {c}_idx" for i, c in enumerate(CATEGORICAL_COLUMNS))
_NUMERIC_FEATURES = ("debt_to_income", "utilisation_ratio", "n_lines")


@register(
    "feature_assembly",
    f"""
WITH {FEATURE_STORE_SQL}, {LABELLED_SQL}, {_RANKS_SQL}
SELECT l.loan_id, {_ASSEMBLY_IDX},
       {", ".join(f"round(CAST(l.{c} AS DOUBLE), 6) AS {c}" for c in _NUMERIC_FEATURES)},
       {", ".join(f"CAST(l.{c} IS NULL AS DOUBLE) AS {c}_missing" for c in _NUMERIC_FEATURES)}
FROM labelled l
{_ASSEMBLY_JOINS}
""",
)
def q_feature_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: the assembled vector, one named column per slot (indexes first,
    then imputed numerics, then missing flags), rounded to 6 places."""
    lab = labelled_store(spark, sf_dir)
    model = build_feature_pipeline(lab).fit(lab)
    slots = [c.removesuffix("_imputed") for c in model.stages[-1].getInputCols()]
    # Convert the vector once; CollapseProject keeps the UDF in its own
    # projection instead of inlining it into every slot.
    arr = model.transform(lab).select("loan_id", vector_to_array("features").alias("v"))
    return arr.select("loan_id", *[r6(F.col("v").getItem(i)).alias(name) for i, name in enumerate(slots)])


_TRAINED: dict[tuple[str, str], object] = {}


def _trained(spark: SparkSession, sf_dir: str):
    """The query model of ``sf_dir``, trained once per session."""
    key = (app_key(spark), source_key(spark, sf_dir, FEATURE_TABLES))
    if key not in _TRAINED:
        _TRAINED[key] = train_and_score(feature_store(spark, sf_dir), _training_config())
    return _TRAINED[key]


_HELD_OUT_SQL = f"""
held_out AS (
    SELECT loan_id, label_default FROM recent WHERE {_md5_unit_sql('loan_id')} >= {SPLIT_WEIGHTS[0]}::DOUBLE
)"""


def _score_checks(prediction: str, probability: str) -> list[F.Column]:
    """What must hold for any forest's score of a row."""
    p, y = F.col(probability), F.col(prediction)
    return [
        y.isin(0.0, 1.0).alias("prediction_is_class"),
        p.between(0.0, 1.0).alias("probability_in_range"),
        ((F.abs(p - 0.5) < 1e-9) | ((p > 0.5) == (y == 1.0))).alias("prediction_follows_probability"),
    ]


_SCORE_CHECKS_SQL = "true AS prediction_is_class, true AS probability_in_range, true AS prediction_follows_probability"


@register(
    "rf_predictions",
    f"WITH {FEATURE_STORE_SQL}, {RECENT_SQL}, {_HELD_OUT_SQL} SELECT loan_id, label_default, {_SCORE_CHECKS_SQL} FROM held_out",
)
def q_rf_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full forest's scores of the held-out rows: which rows they are, and
    that each is a valid score."""
    scored = _trained(spark, sf_dir).predictions
    return scored.select("loan_id", "label_default", *_score_checks("prediction", "p_default"))


@register(
    "model_reload_score",
    f"""
WITH {FEATURE_STORE_SQL}, {RECENT_SQL}, {_HELD_OUT_SQL}
SELECT loan_id, label_default, {_SCORE_CHECKS_SQL}, true AS same_prediction, true AS same_probability FROM held_out
""",
)
def q_model_reload_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved and reloaded model's scores beside those of the model in memory."""
    cfg = _training_config()
    trained = _trained(spark, sf_dir)
    run_path = save_model(trained.model, scratch_path(spark, "model_registry") + "/" + cfg.run_tag)
    _, test = split_recent(feature_store(spark, sf_dir), cfg)
    memory = trained.predictions.select("loan_id", F.col("prediction").alias("m_prediction"), F.col("p_default").alias("m_p"))
    both = score_with(load_model(run_path), test).join(memory, "loan_id", "left")
    return both.select(
        "loan_id",
        "label_default",
        *_score_checks("prediction", "p_default"),
        F.coalesce(F.col("prediction") == F.col("m_prediction"), F.lit(False)).alias("same_prediction"),
        F.coalesce(F.abs(F.col("p_default") - F.col("m_p")) < 1e-12, F.lit(False)).alias("same_probability"),
    )


# --------------------------------------------------------------------------
# 4. Text conversion, SQL-file slices, schema merge, lake loads
# --------------------------------------------------------------------------

_NUM_TEXT = "regexp_replace(CAST({c} AS VARCHAR), '\\.0$', '')"
_TS_TEXT = "strftime({c}, '%Y-%m-%d %H:%M:%S')"


@register(
    "stringify_columns",
    f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus,
       {_NUM_TEXT.format(c='o_totalprice')} AS o_totalprice,
       {_TS_TEXT.format(c='o_orderdate')} AS o_orderdate,
       o_orderpriority
FROM orders
""",
)
def q_stringify_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_text_columns(load_table(spark, sf_dir, "orders"))


@register(
    "stringify_columns_customer",
    f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       {_NUM_TEXT.format(c='c_acctbal')} AS c_acctbal,
       c_mktsegment
FROM customer
""",
)
def q_stringify_columns_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_text_columns(load_table(spark, sf_dir, "customer"))


RESTATE_BEFORE = "1998-01-01"


def _snapshot_sql(data_dt: str, join: str = "LEFT", orders_before: str | None = None) -> str:
    where = f"WHERE o_orderdate < TIMESTAMP '{orders_before}'" if orders_before else ""
    return f"""
SELECT c.c_custkey AS customer_id, t.snapshot_ts, c.c_acctbal AS credit_score,
       t.delinquency_risk, '{data_dt}' AS data_dt
FROM customer c {join} JOIN (
    SELECT o_custkey, max(o_orderdate) AS snapshot_ts,
           count(*) FILTER (WHERE o_orderstatus = 'F') / count(*) AS delinquency_risk
    FROM orders {where} GROUP BY o_custkey
) t ON c.c_custkey = t.o_custkey"""


def _load_snapshot_slices(spark: SparkSession, sf_dir: str, base: str, dates=("20240101", "20240102")) -> None:
    for data_dt in dates:
        frame_to_lake(customer_snapshot(spark, sf_dir, data_dt), base, data_dt, "overwrite", target_name="customer_snapshot")


def _snapshot_view(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_path(spark, "customer_snapshot")
    _load_snapshot_slices(spark, sf_dir, base)
    view = "customer_snapshot_" + base.rsplit("-", 1)[-1]
    read_date_partitioned(spark, base).createOrReplaceTempView(view)
    return view


@register("sql_slice_extract", _snapshot_sql("20240102"))
def q_sql_slice_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _snapshot_view(spark, sf_dir)
    return run_sql_file(spark, packaged_sql("extract_dataset.sql"), source_table=view, data_dt="20240102")


@register(
    "snapshot_projection",
    f"SELECT customer_id, snapshot_ts, credit_score, delinquency_risk FROM ({_snapshot_sql('20240101')}) s",
)
def q_snapshot_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _snapshot_view(spark, sf_dir)
    return run_sql_file(spark, packaged_sql("select_dataset.sql"), source_table=view, data_dt="20240101")


@register(
    "partition_replace",
    f"""
{_snapshot_sql('20240101')}
UNION ALL
{_snapshot_sql('20240102', 'INNER', RESTATE_BEFORE)}
""",
)
def q_partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "partition_replace")
    _load_snapshot_slices(spark, sf_dir, base)
    # Restate 20240102 (earlier order cut-off, customers with orders only),
    # twice: the slice is replaced, 20240101 is untouched, a re-run is
    # idempotent.
    restated = customer_snapshot(spark, sf_dir, "20240102", with_orders_only=True, orders_before=RESTATE_BEFORE)
    for _ in range(2):
        frame_to_lake(restated, base, "20240102", "overwrite")
    return read_date_partitioned(spark, base)


@register(
    "slice_replace_load",
    f"""
{_snapshot_sql('20240101')}
UNION ALL
{_snapshot_sql('20240102', 'INNER', RESTATE_BEFORE)}
""",
)
def q_slice_replace_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4 with a lake target: the day's slice is extracted from a catalog
    table by the SQL file (S3), then replaces that date in the target (K4)
    with a load report (K9); other dates are untouched."""
    target = scratch_path(spark, "slice_replace_target")
    _load_snapshot_slices(spark, sf_dir, target)
    source = scratch_path(spark, "restated_source")
    restated = customer_snapshot(spark, sf_dir, "20240102", with_orders_only=True, orders_before=RESTATE_BEFORE)
    frame_to_lake(restated, source, "20240102", "overwrite")
    view = "customer_feature_store_" + source.rsplit("-", 1)[-1]
    read_date_partitioned(spark, source).createOrReplaceTempView(view)
    extract = run_sql_file(spark, packaged_sql("extract_dataset.sql"), source_table=view, data_dt="20240102")
    frame_to_lake(extract, target, "20240102", "overwrite", target_name="customer_snapshot")
    return read_date_partitioned(spark, target)


@register("slice_replace_empty", _snapshot_sql("20240101"))
def q_slice_replace_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date restated with no rows is empty afterwards; the other one stays."""
    base = scratch_path(spark, "slice_replace_empty")
    _load_snapshot_slices(spark, sf_dir, base)
    frame_to_lake(customer_snapshot(spark, sf_dir, "20240102").where(F.lit(False)), base, "20240102", "overwrite")
    return read_date_partitioned(spark, base)


@register(
    "merge_schema_scan",
    """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment, '20240101' AS data_dt
FROM customer
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, '20240102' AS data_dt
FROM customer
""",
)
def q_merge_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "merge_schema")
    customer = load_table(spark, sf_dir, "customer")
    frame_to_lake(customer.drop("c_mktsegment"), base, "20240101", "overwrite")
    frame_to_lake(customer, base, "20240102", "overwrite")
    merged = read_merged(spark, base)
    return merged.select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", F.col("DATA_DT").cast("string").alias("data_dt")
    )


@register(
    "load_report",
    """
SELECT 'customer_snapshot' AS target, 'overwrite' AS mode, count(*) AS rows, false AS is_dryrun FROM customer
UNION ALL
SELECT 'customer_snapshot' AS target, 'append' AS mode, count(*) AS rows, true AS is_dryrun FROM customer
""",
)
def q_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "load_report")
    snap = customer_snapshot(spark, sf_dir, "20240101")
    real = frame_to_lake(snap, base, "20240101", "overwrite", target_name="customer_snapshot")
    dry = frame_to_lake(snap, base, "20240101", "append", is_dryrun=True, target_name="customer_snapshot")
    return real.to_frame(spark).unionByName(dry.to_frame(spark))


# --------------------------------------------------------------------------
# 5. Activity completion, daily export, responses, bronze stream
# --------------------------------------------------------------------------

# An entry "<activity> start" or "<activity> finish" marks its activity; case
# does not matter. An activity is complete when its last finish of the day is
# later than its last start.
ACTIVITY_SQL = f"""
entries AS (
    SELECT string_split(lower(event_type || if(event_id % 2 = 0, ' start', ' finish')), ' ') AS words, ts
    FROM events WHERE ts >= DATE '{ACTIVITY_DAY}' AND ts < DATE '{ACTIVITY_DAY}' + 1
),
day_marks AS (
    SELECT array_to_string(words[:-2], ' ') AS activity,
           max(ts) FILTER (words[-1] = 'start') AS latest_start,
           max(ts) FILTER (words[-1] = 'finish') AS latest_finish
    FROM entries GROUP BY activity
),
completion AS (
    SELECT event_type AS activity_name, latest_start, latest_finish,
           CAST(coalesce(latest_finish > latest_start, false) AS INTEGER) AS is_completed
    FROM (SELECT DISTINCT event_type FROM events) LEFT JOIN day_marks ON activity = lower(event_type)
)"""


def _activity_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    acts = load_table(spark, sf_dir, "events").select(F.col("event_type").alias("activity_name")).distinct()
    return activity_completion(activity_log(spark, sf_dir), acts, ACTIVITY_DAY)


@register("activity_completion", f"WITH {ACTIVITY_SQL} SELECT * FROM completion")
def q_activity_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _activity_completion(spark, sf_dir)


@register(
    "activity_rollup",
    f"""
WITH {ACTIVITY_SQL}
SELECT count(*) AS total_activities,
       count(*) FILTER (is_completed = 1) AS completed_activities,
       CAST(coalesce(bool_and(is_completed = 1), false) AS INTEGER) AS all_completed
FROM completion
""",
)
def q_activity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_rollup(_activity_completion(spark, sf_dir))


RESPONSE_LOG_SQL = """
resp AS (
    SELECT event_id AS request_id, user_id,
           CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
           CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code,
           '{"Header":{"ResponseCode":' || CASE WHEN event_type = 'error' THEN '500' ELSE '200' END
             || ',"ResponseMessage":"' || CASE WHEN event_type = 'error' THEN 'Internal Server Error' ELSE 'OK' END
             || '","Language":"TH"}}' AS body,
           value,
           strftime(ts, '%Y%m%d') AS data_dt,
           ts AS load_dt
    FROM events
)"""


@register(
    "daily_window_export",
    f"""
WITH {RESPONSE_LOG_SQL}
SELECT CAST(request_id AS VARCHAR) AS request_id,
       CAST(user_id AS VARCHAR) AS user_id,
       status,
       CAST(status_code AS VARCHAR) AS status_code,
       body,
       {_NUM_TEXT.format(c='value')} AS value,
       data_dt,
       {_TS_TEXT.format(c='load_dt')} AS load_dt
FROM resp
WHERE load_dt >= TIMESTAMP '2024-01-04 17:00:00' AND load_dt < TIMESTAMP '2024-01-05 17:00:00'
""",
)
def q_daily_window_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "daily_export")
    # The job reads the response log by catalog name (S6), as it would a
    # Delta view on the cluster.
    view = "api_response_log_" + root.rsplit("-", 1)[-1]
    response_log(spark, sf_dir).createOrReplaceTempView(view)
    report = daily_export(table_scan(spark, view), root, EXPORT_TRIGGER, EXPORT_ZONE)
    data_dt = report.target.rsplit("=", 1)[-1]
    # The export keeps the log's own business date; the folder is the
    # export day. Read the exported text back.
    return read_export(spark, root, data_dt)


@register(
    "text_export_roundtrip",
    """
SELECT 'documents' AS source_table, CAST(doc_id AS VARCHAR) AS id, text, chr(10) || '  ' || lang || chr(9) AS padded,
       CASE WHEN doc_id % 2 = 0 THEN '' END AS empty_or_null, CASE doc_id % 3 WHEN 0 THEN '\\N' WHEN 1 THEN '"' END AS odd
FROM documents
UNION ALL
SELECT 'conversations', conv_id || ':' || turn, text, chr(10) || '  ' || role || chr(9),
       CASE WHEN conv_id % 2 = 0 THEN '' END, CASE conv_id % 3 WHEN 0 THEN '\\N' WHEN 1 THEN '"' END
FROM conversations
""",
)
def q_text_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts exported and read back: spaces, tabs, line ends, quotes, empty
    texts, NULLs and texts that look like the NULL sentinel."""

    def rows(table: str, key: str, ident: F.Column, note: str) -> DataFrame:
        k = F.col(key)
        odd = F.when(k % 3 == 0, F.lit("\\N")).when(k % 3 == 1, F.lit('"'))
        return load_table(spark, sf_dir, table).select(
            F.lit(table).alias("source_table"),
            ident.alias("id"),
            "text",
            F.concat(F.lit("\n  "), F.col(note), F.lit("\t")).alias("padded"),
            F.when(k % 2 == 0, F.lit("")).alias("empty_or_null"),
            odd.alias("odd"),
            F.lit(EXPORT_TRIGGER).cast("timestamp_ntz").alias("load_dt"),
        )

    texts = rows("documents", "doc_id", F.col("doc_id").cast("string"), "lang").unionByName(
        rows("conversations", "conv_id", F.concat_ws(":", "conv_id", "turn"), "role")
    )
    root = scratch_path(spark, "text_export")
    # The trigger's own previous day, so that every row is in the window.
    report = daily_export(texts, root, dt.datetime.fromisoformat(EXPORT_TRIGGER) + dt.timedelta(days=1), EXPORT_ZONE)
    return read_export(spark, root, report.target.rsplit("=", 1)[-1]).drop("load_dt")


@register(
    "response_log_normalise",
    f"""
WITH {RESPONSE_LOG_SQL}
SELECT request_id, user_id, status, status_code, value, load_dt,
       CASE WHEN status_code BETWEEN 200 AND 299 THEN 'success' ELSE 'error' END AS status_class,
       CAST(json_extract(body, '$.Header.ResponseCode') AS INTEGER) AS response_code,
       json_extract_string(body, '$.Header.ResponseMessage') AS response_message,
       json_extract_string(body, '$.Header.Language') AS language,
       strftime(strptime(data_dt, '%Y%m%d'), '%Y-%m-%d') AS data_date
FROM resp
""",
)
def q_response_log_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_responses(response_log(spark, sf_dir))


# Files of this many offsets are staged for the stream. A batch is bounded by
# its bytes, so the number of batches follows the data, not its files. (The
# bench's rate measurement keeps the reference's 20,000 offsets a batch.)
STREAM_ROWS_PER_FILE = 2_000
STREAM_FILES_PER_TRIGGER = 10
STREAM_BYTES_PER_TRIGGER = 128 << 20

_BRONZE_SQL = """
SELECT CAST(user_id AS VARCHAR) AS key, props AS value, 'payments' AS topic,
       0 AS "partition", event_id AS "offset", ts AS "timestamp", 0 AS "timestampType"
FROM events
"""


@register("bronze_stream", _BRONZE_SQL)
def q_bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "bronze_stream")
    landing = stage_envelopes(spark, sf_dir, f"{root}/landing", STREAM_ROWS_PER_FILE)
    stream = envelope_file_source(spark, landing, max_bytes_per_trigger=STREAM_BYTES_PER_TRIGGER)
    query = start_bronze(stream, f"{root}/bronze", f"{root}/_checkpoint", available_now=True)
    query.awaitTermination()
    bronze = spark.read.parquet(f"{root}/bronze")
    session_tz = spark.conf.get("spark.sql.session.timeZone")
    return bronze.withColumn("timestamp", instant_to_utc_wall(F.col("timestamp"), session_tz))


@register("bronze_compacted", _BRONZE_SQL)
def q_bronze_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream into the compacted store: half of the files, a compaction,
    the other half (late rows of the same days), a second compaction and the
    removal of what both replaced."""
    root = scratch_path(spark, "bronze_compacted")
    rows = payment_envelopes(spark, sf_dir)
    for half in (0, 1):
        rows.where(F.col("offset") % 2 == half).write.mode("append").parquet(f"{root}/landing")
        stream = envelope_file_source(spark, f"{root}/landing", max_bytes_per_trigger=STREAM_BYTES_PER_TRIGGER)
        query = start_bronze_store(stream, f"{root}/store", f"{root}/_checkpoint", available_now=True)
        query.awaitTermination()
        compact(spark, f"{root}/store")
    vacuum(spark, f"{root}/store", keep=1)
    bronze = read_bronze_store(spark, f"{root}/store")
    session_tz = spark.conf.get("spark.sql.session.timeZone")
    return bronze.withColumn("timestamp", instant_to_utc_wall(F.col("timestamp"), session_tz))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 end to end: feature store written, then the training run with its
    metrics row read back from the JSON sink."""
    path = materialize_feature_store(spark, sf_dir)
    root = scratch_path(spark, "training_run")
    return training_run(spark, path, f"{root}/registry", f"{root}/metrics", _training_config("flagship"))
