import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from scoreflow.operators.metrics import auc_exact, auc_from_summary, classification_metrics


def _scored(spark, n=3000, seed=5, levels=None):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = rnd.random() < 0.3
        s = rnd.random() * 0.6 + (0.3 if y else 0.0)
        if levels:
            s = round(s * levels) / levels
        rows.append((i, int(y), float(s), float(s > 0.5)))
    return spark.createDataFrame(rows, "loan_id long, label_default int, score double, prediction double")


def _evaluator_auc(df):
    vec = df.select(
        F.col("label_default").cast("double").alias("label"),
        array_to_vector(F.array(1 - F.col("score"), F.col("score"))).alias("rawPrediction"),
    )
    return BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0).evaluate(vec)


@pytest.mark.parametrize("levels", [None, 20])
def test_auc_exact_equals_unbinned_evaluator(spark, levels):
    df = _scored(spark, levels=levels)
    ours = auc_exact(df, "score").first()["auc"]
    assert ours == pytest.approx(_evaluator_auc(df), abs=1e-12)


def test_auc_does_not_depend_on_the_range_count(spark):
    df = _scored(spark, n=4000)
    found = [auc_exact(df, "score", groups_per_range=n).first()["auc"] for n in (2000, 600, 13)]
    assert found == pytest.approx([_evaluator_auc(df)] * 3, abs=1e-12)


def test_auc_of_billions_of_rows_per_class(spark):
    rows = [(0.1, 0, 4_000_000_000), (0.5, 4_000_000_000, 2_000_000_000), (0.9, 8_000_000_000, 0)]
    summary = spark.createDataFrame(rows, "score double, pos bigint, neg bigint")
    # 4e9 positives at 0.5 beat 4e9 negatives and tie with 2e9; 8e9 beat all 6e9.
    want = (4e9 * (4e9 + 1e9) + 8e9 * 6e9) / (12e9 * 6e9)
    assert auc_from_summary(summary).first()["auc"] == pytest.approx(want)


def test_auc_all_tied_is_half(spark):
    df = _scored(spark).withColumn("score", F.lit(0.4))
    assert auc_exact(df, "score").first()["auc"] == pytest.approx(0.5)


def test_no_actual_positives(spark):
    df = _scored(spark).withColumn("label_default", F.lit(0))
    row = classification_metrics(df, "score", "t").first()
    assert row["auc"] is None
    assert row["precision"] == 0.0 and row["recall"] == 0.0


def test_no_predicted_positives(spark):
    df = _scored(spark).withColumn("prediction", F.lit(0.0))
    row = classification_metrics(df, "score", "t").first()
    assert row["precision"] == 0.0
    assert row["recall"] == 0.0


def test_metrics_row_shape(spark):
    row = classification_metrics(_scored(spark), "score", "run1")
    assert row.columns == ["run_tag", "precision", "recall", "auc"]
    assert row.first()["run_tag"] == "run1"


def test_one_pass_metrics_equal_separate_ones(spark):
    df = _scored(spark, n=2000, levels=30)
    # Rows without a score still count for precision and recall.
    df = df.withColumn("score", F.when(F.col("loan_id") % 17 == 0, F.lit(None)).otherwise(F.col("score")))
    row = classification_metrics(df, "score", "t").first()
    pdf = df.toPandas()
    hits = ((pdf.label_default == 1) & (pdf.prediction == 1)).sum()
    assert row["precision"] == pytest.approx(hits / (pdf.prediction == 1).sum())
    assert row["recall"] == pytest.approx(hits / (pdf.label_default == 1).sum())
    assert row["auc"] == pytest.approx(auc_exact(df, "score").first()["auc"])


def test_the_largest_range_does_not_grow_with_the_scores(spark):
    """Twenty times the scores: twenty times the ranges, none of them larger."""
    from scoreflow.operators.prefix import RANGE, sorted_ranges

    largest, number = [], []
    for n in (5_000, 100_000):
        scores = spark.range(n, numPartitions=4).select((F.hash("id") / 2.0**31).alias("score"))
        ranged = sorted_ranges(scores, ["score"], n, rows_per_range=500).groupBy(RANGE).count().collect()
        largest.append(max(r["count"] for r in ranged))
        number.append(len(ranged))
        assert sum(r["count"] for r in ranged) == n
    assert number[1] > 15 * number[0] and max(largest) < 2 * 500


def test_prefix_sums_by_group(spark):
    from scoreflow.operators.prefix import prefix_sums

    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "b", None]), i, rnd.randrange(9), rnd.choice([None, 1, 5])) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, k int, v int, w int")
    want, sums = {}, {}
    for g, k, v, w in sorted(rows, key=lambda r: r[1]):
        a, b = sums.get(g, (0, 0))
        want[k] = (a, b)
        sums[g] = (a + v, b + (w or 0))
    for per in (10_000, 50):
        out = prefix_sums(df, ["k"], ["v", "w"], ["g"], rows_per_range=per)
        assert out.columns == ["g", "k", "v", "w", "before_v", "before_w"]
        assert {r.k: (r.before_v, r.before_w) for r in out.collect()} == want
    assert prefix_sums(df.limit(0), ["k"], ["v"]).count() == 0
