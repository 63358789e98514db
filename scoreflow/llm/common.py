"""Expressions and helpers shared by the corpus operators.

Word classes are the two the query contracts name. Words are always taken by
splitting on the separators: `split` walks the text once and, unlike
`regexp_extract_all`, never evaluates a negated character class per code point.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreflow.session import scratch_path

# Separators of the two word definitions.
SPACES = r"[\x20\x09-\x0D]+"
NON_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NON_WORDS_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. `lower` is right (and much cheaper than a
    per-character `translate`) unless some character outside ASCII would
    change under it."""
    rest = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    return F.when(rest == F.lower(rest), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def split_words(text: Column, separators: str) -> Column:
    """Words between runs of separators; an empty array for an empty text."""
    return F.array_remove(F.split(text, separators), "")


def row_key(doc_id: str = "doc_id", text: Column | str = "text") -> list[Column]:
    """A 96-bit key of (doc_id, text), never null, for joining results back
    to their rows without shuffling the texts. Repeated rows share a key, and
    every result here is a function of (doc_id, text), so they share it too."""
    ident = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    text = F.col(text) if isinstance(text, str) else text
    return [F.xxhash64(F.lit("row"), ident, text).alias("k1"), F.hash(F.lit("key"), ident, text).alias("k2")]


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared scratch folder and read back:
    the plan starts afresh from files that outlive any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Spark removes the shuffle files of an execution as soon as it ends.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the plans made and run inside go when each ends."""
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """As `written`, for jobs of many steps: the step's shuffle files go when
    it ends, and the table itself with `discard`."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with freed_shuffles(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables made by `stored`, once all that reads them is written."""
    for table in tables:
        sc = table.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Arrow batches of the jobs run inside end at `size` bytes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def rows_at_most(df: DataFrame, limit: int) -> bool:
    """Whether `df` has at most `limit` rows (counts no further than that)."""
    return df.limit(limit + 1).count() <= limit


def broadcast_checked(df: DataFrame, limit: int) -> DataFrame:
    """Broadcast hint only for a side counted to be at most `limit` rows."""
    return F.broadcast(df) if rows_at_most(df, limit) else df


def broadcast_weighed(df: DataFrame, weight: Column, limit: int) -> DataFrame:
    """Broadcast hint only if `weight` (about the bytes of a row whose arrays
    or texts vary) sums up to at most `limit`. `df` should be a written table."""
    total = df.agg(F.coalesce(F.sum(weight.cast("long")), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= limit else df


def crc_bucket(column: str, modulus: int) -> Column:
    """crc32(id as text) mod `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus
