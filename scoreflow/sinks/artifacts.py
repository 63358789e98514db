"""K6 / K7: metrics rows and model artifacts.

Paths are plain strings handed to Hadoop's file system, so ``s3://``,
``hdfs://`` or other URI targets keep their scheme (the reference ran
them through ``pathlib``, which collapses ``//`` and then created folders on
the local disk).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

METRICS_COLUMNS = ("run_tag", "precision", "recall", "auc")
METRICS_SCHEMA = "run_tag string, precision double, recall double, auc double"


def save_model(model: PipelineModel, run_path: str) -> str:
    """``<run_path>/pipeline``: the fitted feature stages and forest as one
    ``PipelineModel``; ``<run_path>/model``: the forest alone."""
    model.write().overwrite().save(f"{run_path}/pipeline")
    model.stages[-1].write().overwrite().save(f"{run_path}/model")
    return run_path


def load_model(run_path: str) -> PipelineModel:
    return PipelineModel.load(f"{run_path}/pipeline")


def write_metrics(metrics: DataFrame, metrics_path: str, run_tag: str) -> str:
    """One JSON file per run at ``<metrics_path>/<run_tag>`` (overwrite)."""
    target = f"{metrics_path.rstrip('/')}/{run_tag}"
    metrics.select(*METRICS_COLUMNS).coalesce(1).write.mode("overwrite").json(target)
    return target


def read_metrics(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).json(target)
