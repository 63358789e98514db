"""Per-feature profile: non-NULL count, min and max of every numeric feature.

One scan with one global aggregate (partial per task, one tiny final merge),
then the single wide row is unpivoted into one row per feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.operators.filters import numeric_feature_columns


def feature_columns_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    cols = columns if columns is not None else numeric_feature_columns(df)
    if not cols:
        raise ValueError("no numeric feature columns to profile")
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`").cast("double")
        aggs += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    F.col(f"n{i}").alias("non_null"),
                    F.col(f"lo{i}").alias("min_value"),
                    F.col(f"hi{i}").alias("max_value"),
                )
                for i, c in enumerate(cols)
            ]
        )
    ).alias("r")
    return wide.select(rows).select("r.*")
