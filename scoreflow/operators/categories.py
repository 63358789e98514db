"""M1: category indexes as a table.

Each categorical column's values are counted with partial sums and ranked by
falling count, ties by value. No value reaches the driver, so a column may
have as many values as it likes. NULL and unseen values get one extra index,
the number of known values.

Looking the indexes up is a split join. The most frequent values of all
columns, up to a bound on their bytes, are hot: each column finds them in a
broadcast, so the rows of a frequent value (and of NULL, which is looked up
nowhere) stay where they are. Usually these are all values. Where a column has
more, the cells that are left are looked up together: one join on (feature,
value) for all columns, and one grouping back to their rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreflow.operators.prefix import prefix_sums
from scoreflow.session import scratch_path

RANKS_SCHEMA = "feature string, value string, idx double, hot boolean"
# Bytes of the values (and 32 a row beside them) that are broadcast at most.
HOT_BYTES = 8 << 20
_ROW_BYTES = 32


def index_column(column: str) -> str:
    return f"{column}_idx"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cells(columns: Sequence[str]):
    return F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]))


def category_ranks(df: DataFrame, columns: Sequence[str], hot_bytes: int | None = None) -> DataFrame:
    """(feature, value, idx, hot): rank 0 for the most frequent value of a
    column; hot values are the first ranks of all columns within the bytes."""
    hot_bytes = HOT_BYTES if hot_bytes is None else hot_bytes
    counts = df.select(_cells(columns).alias("r")).select("r.*").where("value IS NOT NULL").groupBy("feature", "value").count()
    counts = _written(counts.withColumn("one", F.lit(1)).withColumn("bytes", F.octet_length("value") + F.lit(_ROW_BYTES)), "category_counts")
    rows, size = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    ranks = prefix_sums(counts, [F.desc("count"), "value"], ["one"], ["feature"], rows=rows)
    ranks = ranks.select("feature", "value", F.col("before_one").cast("double").alias("idx"), "bytes")
    if size <= hot_bytes:
        return ranks.select("feature", "value", "idx", F.lit(True).alias("hot"))
    ahead = prefix_sums(_written(ranks, "category_order"), ["idx", "feature"], ["bytes"], rows=rows)
    return ahead.select("feature", "value", "idx", (F.col("before_bytes") + F.col("bytes") <= hot_bytes).alias("hot"))


class CategoryIndexer(Estimator):
    """Ranks of ``columns``. Those in ``numeric_slots`` enter a model as plain
    numbers; the others carry their number of values, so trees bin them."""

    def __init__(self, columns: Sequence[str], numeric_slots: Sequence[str] = ()):
        super().__init__()
        self.columns, self.numeric_slots = list(columns), list(numeric_slots)

    def _fit(self, dataset: DataFrame) -> CategoryIndexModel:
        ranks = _written(category_ranks(dataset, self.columns), "category_ranks")
        return CategoryIndexModel(self.columns, self.numeric_slots, ranks)


class CategoryIndexModel(Model, MLWritable, MLReadable):
    def __init__(self, columns: Sequence[str] = (), numeric_slots: Sequence[str] = (), ranks: DataFrame | None = None):
        super().__init__()
        self.columns, self.numeric_slots, self.ranks = list(columns), list(numeric_slots), ranks
        self.sizes = {c: 0 for c in self.columns}
        self.cold: list[str] = []
        if ranks is not None:
            # One row per column.
            found = ranks.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.count_if("hot").alias("hot")).collect()
            self.sizes |= {r.feature: r.n for r in found}
            held = {r.feature for r in found if r.hot < r.n}
            self.cold = [c for c in self.columns if c in held]

    def binned_sizes(self) -> dict[str, int]:
        return {c: n for c, n in self.sizes.items() if c not in self.numeric_slots}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for i, c in enumerate(self.columns):
            known = self.ranks.where((F.col("feature") == c) & F.col("hot"))
            known = known.select(F.col("value").alias(f"__v{i}"), F.col("idx").alias(f"__i{i}"))
            out = out.join(F.broadcast(known), F.col(f"`{c}`").cast("string") == F.col(f"__v{i}"), "left").drop(f"__v{i}")
        if self.cold:
            out = self._with_cold(out)
        columns = [F.col(f"`{x}`") for x in dataset.columns]
        for i, c in enumerate(self.columns):
            name, size = index_column(c), self.sizes[c]
            metadata = {} if c in self.numeric_slots else {"ml_attr": {"type": "nominal", "num_vals": size + 1, "name": name}}
            columns.append(F.coalesce(F.col(f"__i{i}"), F.lit(float(size))).alias(name, metadata=metadata))
        return out.select(*columns)

    def _with_cold(self, rows: DataFrame) -> DataFrame:
        """The indexes that no broadcast held. The rows are written with a
        number each; only cells that are neither NULL nor hot are joined."""
        rows = _written(rows.withColumn("__row", F.monotonically_increasing_id()), "indexed")
        at = {c: self.columns.index(c) for c in self.cold}
        cells = F.array(
            *[
                F.when(
                    F.col(f"__i{i}").isNull() & F.col(f"`{c}`").isNotNull(),
                    F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value")),
                )
                for c, i in at.items()
            ]
        )
        left = rows.select("__row", F.explode(F.filter(cells, lambda x: x.isNotNull())).alias("cell")).select("__row", "cell.*")
        found = left.join(self.ranks.where(~F.col("hot")).select("feature", "value", "idx"), ["feature", "value"])
        by_row = found.groupBy("__row").agg(
            *[F.max(F.when(F.col("feature") == c, F.col("idx"))).alias(f"__c{i}") for c, i in at.items()]
        )
        joined = rows.join(by_row, "__row", "left")
        for i in at.values():
            joined = joined.withColumn(f"__i{i}", F.coalesce(f"__i{i}", f"__c{i}")).drop(f"__c{i}")
        return joined.drop("__row")

    def copy(self, extra=None) -> CategoryIndexModel:
        return self

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: CategoryIndexModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        extra = {"columns": self.model.columns, "numericSlots": self.model.numeric_slots}
        DefaultParamsWriter.saveMetadata(self.model, path, spark, extraMetadata={"categories": json.dumps(extra)})
        self.model.ranks.write.parquet(f"{path}/ranks")


class _Reader(MLReader):
    def load(self, path: str) -> CategoryIndexModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        stored = json.loads(metadata["categories"])
        ranks = spark.read.schema(RANKS_SCHEMA).parquet(f"{path}/ranks")
        return CategoryIndexModel(stored["columns"], stored["numericSlots"], ranks)
