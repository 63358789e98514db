"""Classification metrics (A2, A3, A4, M7).

* ``confusion_matrix`` — ``groupBy(label, prediction).count()``.
* ``classification_metrics`` — precision and recall from the same pass; their
  denominators are floored at 1, so an empty class gives 0, not NULL.
* ``auc_exact`` — exact area under the ROC curve (ties count one half),
  equal to ``BinaryClassificationEvaluator`` with ``numBins=0``. The
  evaluator's default down-samples the curve to 1,000 bins.

``auc_exact`` needs, for every distinct score, the number of negatives with
a lower score: a running sum in one global order. Rows are first grouped by
score (partial aggregation), and the groups' running sums come from
``operators.prefix``: as many sorted ranges as the counted groups need, so no
task's share grows with the number of scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreflow.operators.features import LABEL_COLUMN
from scoreflow.operators.prefix import ROWS_PER_RANGE, prefix_sums
from scoreflow.session import ensure_checkpoint_dir


def confusion_matrix(df: DataFrame, label_col: str = LABEL_COLUMN, prediction_col: str = "prediction") -> DataFrame:
    return df.groupBy(label_col, prediction_col).agg(F.count(F.lit(1)).alias("n"))


def score_summary(
    df: DataFrame,
    score: Column | str,
    label_col: str = LABEL_COLUMN,
    prediction_col: str | None = None,
) -> DataFrame:
    """One row per distinct score (rows labelled 0 or 1 only): ``pos``,
    ``neg`` and, with a prediction column, the confusion counts ``tp``,
    ``fp``, ``fn``. A partial aggregate over the input — at most one row per
    distinct score per task crosses the shuffle — written to the shared
    checkpoint folder, so later jobs read the summary, not the input."""
    score_col = F.col(score) if isinstance(score, str) else score
    label = F.col(label_col).cast("double")
    aggs = [F.count_if(label == 1.0).alias("pos"), F.count_if(label == 0.0).alias("neg")]
    if prediction_col is not None:
        pred = F.col(prediction_col).cast("double")
        aggs += [
            F.count_if((label == 1.0) & (pred == 1.0)).alias("tp"),
            F.count_if((label == 0.0) & (pred == 1.0)).alias("fp"),
            F.count_if((label == 1.0) & (pred == 0.0)).alias("fn"),
        ]
    ensure_checkpoint_dir(df.sparkSession)
    return (
        df.filter(label.isin(0.0, 1.0))
        .groupBy(score_col.cast("double").alias("score"))
        .agg(*aggs)
        .checkpoint(eager=True)
    )


def auc_exact(
    df: DataFrame,
    score: Column | str,
    label_col: str = LABEL_COLUMN,
    groups_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One row, column ``auc``: NULL when there are no positives or no
    negatives. Rows whose score is NULL or NaN are left out."""
    return auc_from_summary(score_summary(df, score, label_col), groups_per_range)


def auc_from_summary(summary: DataFrame, groups_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    groups = summary.filter(F.col("score").isNotNull() & ~F.isnan("score")).select("score", "pos", "neg")
    below = prefix_sums(groups, ["score"], ["neg"], rows_per_range=groups_per_range)
    contrib = below.select("pos", "neg", (F.col("pos") * (F.col("before_neg") + F.col("neg") / 2.0)).alias("c"))
    # Each class's count fits a bigint, their product need not.
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return contrib.agg(F.try_divide(F.sum("c"), pairs).cast(T.DoubleType()).alias("auc"))


def classification_metrics(
    df: DataFrame,
    score: Column | str,
    run_tag: str,
    label_col: str = LABEL_COLUMN,
    prediction_col: str = "prediction",
) -> DataFrame:
    """M7: one row ``run_tag, precision, recall, auc`` (the reference's
    metrics row). One pass over the predictions builds the per-score
    summary; precision, recall and AUC are all computed from it, and the
    two one-row results are merged by a union and a final aggregate — no
    driver round trip, no cross join."""
    summary = score_summary(df, score, label_col, prediction_col)
    tp, fp, fn = (F.coalesce(F.sum(c), F.lit(0)) for c in ("tp", "fp", "fn"))
    pr = summary.agg(
        (tp / F.greatest(tp + fp, F.lit(1))).alias("precision"),
        (tp / F.greatest(tp + fn, F.lit(1))).alias("recall"),
        F.lit(None).cast("double").alias("auc"),
    )
    auc = auc_from_summary(summary).select(
        F.lit(None).cast("double").alias("precision"), F.lit(None).cast("double").alias("recall"), "auc"
    )
    return pr.unionByName(auc).agg(
        F.lit(run_tag).alias("run_tag"),
        F.max("precision").alias("precision"),
        F.max("recall").alias("recall"),
        F.max("auc").alias("auc"),
    )
