import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from scoreflow.operators.filters import drop_unlabelled, filter_recent, numeric_feature_columns
from scoreflow.operators.ml import build_feature_pipeline, category_sizes, fit_scoring_model, positive_probability
from scoreflow.plans.training import score_with
from scoreflow.session import scratch_path
from scoreflow.sinks.artifacts import load_model, save_model

SCHEMA = (
    "loan_id long, snapshot_date date, label_default int, debt_to_income double, utilisation_ratio double, "
    "customer_segment string, region string, occupation string, loan_subtype string"
)


def _edge_frame(spark):
    d = dt.date
    rows = [
        (1, None, 1, 0.5, 0.1, "A", "R1", "O1", "S1"),  # NULL date
        (2, d(2001, 5, 1), None, 0.5, 0.1, "A", "R1", "O1", "S1"),  # NULL label
        (3, d(2001, 2, 1), 0, 0.7, 0.2, "B", "R2", "O2", "S2"),  # exactly at the cut-off
        (4, d(2002, 1, 1), 1, 0.9, None, "A", "R1", "O1", "S1"),  # future date, NULL numeric
        (5, d(2001, 1, 31), 1, 0.5, 0.1, "A", "R1", "O1", "S1"),  # one day too old
        (6, d(2001, 7, 1), 2, 0.4, 0.3, "C", "R1", "O3", "S1"),  # label 2
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_recency_and_dropna(spark):
    df = drop_unlabelled(filter_recent(_edge_frame(spark), 6, as_of=dt.date(2001, 8, 1)))
    assert sorted(r["loan_id"] for r in df.collect()) == [3, 4, 6]


def test_recency_cutoff_is_pushed_to_parquet(spark):
    path = scratch_path(spark, "t_fs")
    _edge_frame(spark).write.parquet(path)
    plan = filter_recent(spark.read.parquet(path), 6, as_of=dt.date(2001, 8, 1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(snapshot_date,2001-02-01)" in plan


def test_numeric_columns_by_exclusion(spark):
    df = _edge_frame(spark).withColumn("note", F.lit("x")).withColumn("flag", F.lit(True))
    assert numeric_feature_columns(df) == ["debt_to_income", "utilisation_ratio", "flag"]


def test_pipeline_unseen_category_and_nulls(spark):
    train = _edge_frame(spark).filter("label_default IN (0, 1)")
    model = build_feature_pipeline(train).fit(train)
    unseen = spark.createDataFrame([(9, None, 1, None, None, "ZZZ", None, "O1", "S1")], SCHEMA)
    vec = model.transform(unseen).select("features").first()[0].toArray()
    sizes = category_sizes(model)
    assert vec[0] == sizes["customer_segment"]  # unseen -> extra index
    assert vec[3] == sizes["region"]  # NULL -> the same extra index
    assert not any(x != x for x in vec)  # no NaN reaches the forest


def test_frequency_then_alphabetical_index(spark):
    from scoreflow.operators.categories import category_ranks

    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "customer_segment string")
    ranks = {r.value: r.idx for r in category_ranks(df, ["customer_segment"]).collect()}
    assert ranks == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_fifty_thousand_categories(spark):
    from scoreflow.operators.ml import category_indexer

    n = 50_000
    rows = spark.range(2 * n).selectExpr(
        "id AS loan_id", "DATE '2001-06-01' AS snapshot_date", "CAST(id % 2 AS INT) AS label_default", "CAST(id % 7 AS DOUBLE) AS debt_to_income",
        "0.1D AS utilisation_ratio", "CAST(id % 3 AS STRING) AS customer_segment", "'R' AS region",
        f"CAST(CASE WHEN id < {n} THEN id ELSE 0 END AS STRING) AS occupation", "'S' AS loan_subtype",
    )
    model = category_indexer(["occupation", "region"]).fit(rows)
    assert model.sizes == {"occupation": n, "region": 1}
    index = model.transform(rows).groupBy("occupation_idx").count()
    assert index.count() == n and index.where("occupation_idx = 0").first()["count"] == n + 1
    # As a numeric slot it leaves the forest's bins alone.
    small = rows.where("loan_id % 40 = 0")
    fitted = fit_scoring_model(small, num_trees=2, numeric_slots=["occupation"])
    assert fitted.stages[-1].getOrDefault("maxBins") == 32
    path = save_model(fitted, scratch_path(spark, "t_slots") + "/run")
    a = [tuple(r) for r in score_with(fitted, small).orderBy("loan_id").limit(50).collect()]
    assert a == [tuple(r) for r in score_with(load_model(path), small).orderBy("loan_id").limit(50).collect()]


def test_wide_category_raises_max_bins_and_reload_scores_equal(spark):
    rows = [(i, dt.date(2001, 6, 1), i % 2, float(i % 7), float(i % 5) / 10, f"seg{i % 41}", "R", "O", "S") for i in range(400)]
    train = spark.createDataFrame(rows, SCHEMA)
    model = fit_scoring_model(train, num_trees=5)
    assert model.stages[-1].getOrDefault("maxBins") >= 42
    path = save_model(model, scratch_path(spark, "t_model") + "/run")
    again = load_model(path)
    a = {r["loan_id"]: (r["prediction"], r["p_default"]) for r in score_with(model, train).collect()}
    b = {r["loan_id"]: (r["prediction"], r["p_default"]) for r in score_with(again, train).collect()}
    assert a == b


def test_model_scores_after_observe(spark):
    from scoreflow.sinks.lake import write_observed

    write_observed(spark.range(3), lambda f: f.write.format("noop").mode("overwrite").save())
    rows = [(i, dt.date(2001, 6, 1), i % 2, float(i), 0.1, "A", "R", "O", "S") for i in range(50)]
    train = spark.createDataFrame(rows, SCHEMA)
    model = fit_scoring_model(train, num_trees=3)
    assert model.transform(train).select(positive_probability()).count() == 50


def test_training_with_default_ratio_and_other_labels(spark):
    from scoreflow.plans.training import TrainingConfig, train_and_score

    rows = [
        (i, dt.date(2001, 6, 1), (2 if i % 25 == 0 else i % 2), float(i % 11), 0.1 * (i % 3), "A" if i % 3 else "B", "R", "O", "S")
        for i in range(600)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    cfg = TrainingConfig(run_tag="t", sampling_ratio=1.0, as_of=dt.date(2001, 8, 1), num_trees=3)
    result = train_and_score(df, cfg)
    m = result.metrics.first()
    assert m["run_tag"] == "t" and 0.0 <= m["auc"] <= 1.0
    assert result.predictions.count() > 0


def test_profile_with_null_and_boolean_columns(spark):
    from scoreflow.operators.profile import feature_columns_profile

    df = _edge_frame(spark).withColumn("empty", F.lit(None).cast("double")).withColumn("flag", F.col("loan_id") > 3)
    rows = {r["feature"]: r for r in feature_columns_profile(df).collect()}
    assert set(rows) == {"debt_to_income", "utilisation_ratio", "empty", "flag"}
    assert rows["empty"]["non_null"] == 0 and rows["empty"]["min_value"] is None
    assert (rows["flag"]["min_value"], rows["flag"]["max_value"]) == (0.0, 1.0)
    assert rows["utilisation_ratio"]["non_null"] == 5


def _training_rows(spark, label=lambda i: i % 2, ratio=lambda i: 0.1 * (i % 3), debt=lambda i: float(i % 11)):
    rows = [(i, dt.date(2001, 6, 1), label(i), debt(i), ratio(i), "A" if i % 3 else "B", "R", "O", "S") for i in range(400)]
    return spark.createDataFrame(rows, SCHEMA)


def test_column_without_values_is_zero_with_its_flag(spark):
    train = _training_rows(spark, ratio=lambda i: None, debt=lambda i: float("nan") if i % 4 == 0 else 2.0 * i)
    model = build_feature_pipeline(train).fit(train)
    slots = model.stages[-1].getInputCols()
    for r in model.transform(train).select("loan_id", "features").collect():
        value = dict(zip(slots, r.features.toArray()))
        assert value["utilisation_ratio_imputed"] == 0.0 and value["utilisation_ratio_missing"] == 1.0
        assert value["debt_to_income_missing"] == float(r.loan_id % 4 == 0)
        assert value["debt_to_income_imputed"] == value["debt_to_income_imputed"]
    assert fit_scoring_model(train, num_trees=2).transform(train).count() == 400


@pytest.mark.parametrize("label", [0, 1])
def test_sample_of_one_class_scores(spark, label):
    from scoreflow.plans.training import TrainingConfig, train_and_score

    cfg = TrainingConfig(run_tag="one", as_of=dt.date(2001, 8, 1), num_trees=2)
    result = train_and_score(_training_rows(spark, label=lambda i: label), cfg)
    assert {r.p_default for r in result.predictions.collect()} == {float(label)}
    assert result.metrics.first()["auc"] is None


def test_forest_beats_one_trained_on_shuffled_labels(spark):
    from scoreflow.operators.metrics import auc_exact
    from scoreflow.plans.training import TrainingConfig, train_and_score

    true = lambda i: int(i % 11 > 5)
    cfg = TrainingConfig(run_tag="t", as_of=dt.date(2001, 8, 1))
    real = train_and_score(_training_rows(spark, label=true), cfg).predictions
    noise = train_and_score(_training_rows(spark, label=lambda i: (i * 7919 >> 3) % 2), cfg).model
    _, held = __import__("scoreflow.plans.training", fromlist=["split_recent"]).split_recent(_training_rows(spark, label=true), cfg)
    a = auc_exact(real, "p_default").first()["auc"]
    b = auc_exact(score_with(noise, held), "p_default").first()["auc"]
    assert a > 0.95 and a > b + 0.2


def _categories(spark, n=3000):
    import random

    rnd = random.Random(4)
    rows = []
    for i in range(n):
        pick = lambda k: None if rnd.random() < 0.1 else f"v{min(int(rnd.expovariate(0.05)), k)}"
        hot = "hot" if i % 3 == 0 else pick(400)
        rows.append((i, hot, pick(300), pick(2), rnd.choice([None, 1, 2, 33])))
    return rows, spark.createDataFrame(rows, "id int, a string, `b c` string, c string, d int").repartition(4)


@pytest.mark.parametrize("hot_bytes", [0, 2_000, 8 << 20])
def test_split_lookup_of_four_columns(spark, monkeypatch, hot_bytes):
    """Hot, cold, unseen and NULL values: the same indexes at every bound."""
    from collections import Counter

    from scoreflow.operators import categories

    monkeypatch.setattr(categories, "HOT_BYTES", hot_bytes)
    rows, df = _categories(spark)
    columns = ["a", "b c", "c", "d"]
    model = categories.CategoryIndexer(columns).fit(df)
    ranks = model.ranks.collect()
    held = sum(len(r.value.encode()) + 32 for r in ranks if r.hot)
    assert held <= hot_bytes and (hot_bytes < 8 << 20 or all(r.hot for r in ranks))
    assert bool(model.cold) == (hot_bytes < 8 << 20)
    if hot_bytes == 2_000:
        assert {r.value for r in ranks if r.hot and r.feature == "a"} >= {"hot"}
    want = []
    for k in range(1, 5):
        seen = Counter(str(r[k]) for r in rows if r[k] is not None)
        order = sorted(seen, key=lambda v: (-seen[v], v))
        want.append({v: float(i) for i, v in enumerate(order)})
    new = spark.createDataFrame([(90_000, "never", None, "v1", 77), (90_001, None, None, None, None)], df.schema)
    out = model.transform(df.unionByName(new))
    assert out.columns == [*df.columns, "a_idx", "b c_idx", "c_idx", "d_idx"]
    got = {r[0]: r for r in out.collect()}
    assert len(got) == len(rows) + 2
    for r in [*rows, *[tuple(x) for x in new.collect()]]:
        assert [got[r[0]][5 + k] for k in range(4)] == [
            want[k].get(str(r[1 + k]) if r[1 + k] is not None else None, float(len(want[k]))) for k in range(4)
        ]


def test_four_columns_are_looked_up_in_one_join(spark, monkeypatch):
    from scoreflow.operators import categories

    monkeypatch.setattr(categories, "HOT_BYTES", 500)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, df = _categories(spark)
        out = categories.CategoryIndexer(["a", "b c", "c", "d"]).fit(df).transform(df)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join" in line]
        # By (feature, value), and back to the rows.
        assert len(joins) == 2 and sum("feature" in j for j in joins) == 1
        monkeypatch.setattr(categories, "HOT_BYTES", 8 << 20)
        hot = categories.CategoryIndexer(["a", "b c", "c", "d"]).fit(df).transform(df)
        assert hot._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_forest_rows_are_dealt_over_all_cores(spark, sf_mid, monkeypatch):
    """However few files the recent months are, training and scoring run on
    as many tasks as there are cores, of even size, on all rows."""
    from scoreflow import registry
    from scoreflow.plans import training
    from scoreflow.plans.feature_store import feature_store

    cores, seen, write = spark.sparkContext.defaultParallelism, {}, training._written

    def kept(df, name):
        seen[name] = df.rdd.glom().map(len).collect()
        return write(df, name)

    monkeypatch.setattr(training, "_written", kept)
    monkeypatch.setattr(training, "LEAST_ROWS", 20)
    cfg = dataclasses.replace(registry._training_config(), num_trees=3)
    training.train_and_score(feature_store(spark, sf_mid).coalesce(1), cfg)
    assert len(seen["recent_set"]) == len(seen["held_out_set"]) == 1
    for name, source in (("training_set", "recent_set"), ("held_out_scores", "held_out_set")):
        sizes = seen[name]
        assert len(sizes) == cores and sum(sizes) == seen[source][0] and max(sizes) <= 2 * min(sizes) + 2
    monkeypatch.setattr(training, "MOST_ROWS", 10)
    small = training.spread(spark.range(0, 101, 1, 1))
    assert small.rdd.getNumPartitions() == 11 and small.count() == 101
    assert training.spread(spark.range(0).coalesce(1)).rdd.getNumPartitions() == 1
