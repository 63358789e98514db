"""ML stages (M1, M2, M3, M5, M6).

* Category indexing: ranks of all categorical columns as one written table
  (``operators.categories``) — most frequent value gets 0, ties alphabetical;
  NULL and unseen values get one extra index.
* NULL numerics: the reference's assembler turns them into NaN, which the
  forest rejects. Here an ``Imputer`` (median) fills them and a 0/1
  ``<col>_missing`` flag keeps the information.
* ``VectorAssembler`` puts categorical indexes first, then numerics in frame
  order, as the reference does.
* The forest's ``maxBins`` is raised to the widest binned category + 1 when
  one has more values than the default 32 bins allow. Columns named as
  ``numeric_slots`` (none by default) enter as their rank instead, so a column
  of very many values does not widen every node's histogram.

All fitting is Spark ML: indexers and imputer are distributed aggregates,
the forest grows its trees with distributed histogram passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreflow.operators.categories import CategoryIndexer, index_column
from scoreflow.operators.features import CATEGORICAL_COLUMNS, LABEL_COLUMN
from scoreflow.operators.filters import numeric_feature_columns

FEATURES = "features"

# The reference's forest settings.
NUM_TREES = 200
MAX_DEPTH = 8
SUBSAMPLING_RATE = 0.8
DEFAULT_MAX_BINS = 32


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def category_indexer(categorical: Sequence[str], numeric_slots: Sequence[str] = ()) -> CategoryIndexer:
    """M1 for all categorical columns in one pass over the data."""
    return CategoryIndexer(categorical, numeric_slots)


def build_feature_pipeline(
    df: DataFrame,
    categorical: Sequence[str] = CATEGORICAL_COLUMNS,
    numeric: Sequence[str] | None = None,
    impute: bool = True,
    numeric_slots: Sequence[str] = (),
) -> Pipeline:
    numeric = list(numeric) if numeric is not None else numeric_feature_columns(df)
    stages = [category_indexer(categorical, numeric_slots)] if categorical else []
    inputs = [index_column(c) for c in categorical]
    if impute and numeric:
        value = {c: f"CAST({_q(c)} AS DOUBLE)" for c in numeric}
        missing = {c: f"({_q(c)} IS NULL OR isnan({value[c]}))" for c in numeric}
        # A column without any value has no median: it is 0.0 with its flag set.
        seen = df.agg(*[F.expr(f"count_if(NOT {missing[c]})").alias(str(i)) for i, c in enumerate(numeric)]).first()
        known = [c for i, c in enumerate(numeric) if seen[i]]
        columns = [f"CAST({missing[c]} AS DOUBLE) AS {_q(c + '_missing')}" for c in numeric]
        columns += [
            f"{value[c]} AS {_q(c + '_num')}" if c in known else f"CAST(0 AS DOUBLE) AS {_q(c + '_imputed')}" for c in numeric
        ]
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__"))
        if known:
            stages.append(
                Imputer(
                    inputCols=[c + "_num" for c in known],
                    outputCols=[c + "_imputed" for c in known],
                    strategy="median",
                )
            )
        inputs += [c + "_imputed" for c in numeric] + [c + "_missing" for c in numeric]
    else:
        inputs += list(numeric)
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="keep"))
    return Pipeline(stages=stages)


def category_sizes(feature_model: PipelineModel) -> dict[str, int]:
    """Number of known values per binned column."""
    out = {}
    for stage in feature_model.stages:
        if hasattr(stage, "binned_sizes"):
            out |= stage.binned_sizes()
    return out


def forest(
    max_bins: int = DEFAULT_MAX_BINS,
    num_trees: int = NUM_TREES,
    max_depth: int = MAX_DEPTH,
    subsampling_rate: float = SUBSAMPLING_RATE,
    seed: int = 42,
    label_col: str = LABEL_COLUMN,
) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=label_col,
        featuresCol=FEATURES,
        numTrees=num_trees,
        maxDepth=max_depth,
        subsamplingRate=subsampling_rate,
        maxBins=max_bins,
        seed=seed,
        # More nodes per pass over the data (fewer passes for deep forests),
        # and node ids cached with the data instead of shipping the trees.
        maxMemoryInMB=512,
        cacheNodeIds=True,
    )


def fit_scoring_model(
    train: DataFrame,
    num_trees: int = NUM_TREES,
    seed: int = 42,
    label_col: str = LABEL_COLUMN,
    categorical: Sequence[str] = CATEGORICAL_COLUMNS,
    numeric_slots: Sequence[str] = (),
) -> PipelineModel:
    """Feature stages fitted on ``train`` (not before the split: no leakage),
    then the forest; returned as one ``PipelineModel``."""
    feature_model = build_feature_pipeline(train, categorical, numeric_slots=numeric_slots).fit(train)
    widest = max(category_sizes(feature_model).values(), default=0) + 1  # + the "keep" slot
    max_bins = max(DEFAULT_MAX_BINS, widest)
    labelled = train.withColumn(label_col, F.col(label_col).cast("double"))
    rf_model = forest(max_bins=max_bins, num_trees=num_trees, seed=seed, label_col=label_col).fit(
        feature_model.transform(labelled)
    )
    # A fitted model keeps its training summary, which holds the session; in
    # Spark 4.1 a session that has used DataFrame.observe (our load reports)
    # is no longer serializable, so scoring would fail. The JVM-side copy is
    # the same forest without the summary.
    rf_model = rf_model.copy()
    return PipelineModel(stages=[*feature_model.stages, rf_model])


def positive_probability(column: str = "probability") -> Column:
    """Probability of class 1 from an ML probability vector; 0 from a model
    that has seen class 0 only."""
    return F.coalesce(F.get(vector_to_array(F.col(column)), F.lit(1)), F.lit(0.0))
