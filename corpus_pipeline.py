"""The corpus pipeline: five stages over `documents`, each applying one corpus
operator to all that its predecessor kept. A stage takes (spark, docs, sf_dir);
its result is written as Parquet to the shared scratch folder and read again as
the next one's documents. All but the last return the columns of documents.

Rows that share a doc_id are one document and stay or go together in the
near-duplicate stage; a row with a null doc_id is nobody's duplicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreflow.llm import toxicity
from scoreflow.llm.common import broadcast_checked, read_table, written
from scoreflow.llm.decontaminate import decontaminate
from scoreflow.llm.jaccard_join import jaccard_components
from scoreflow.llm.piece_codec import encode_documents, read_model
from scoreflow.llm.secret_scan import redact_secrets

# Ids that a stage drops are broadcast up to this many; more of them shuffle.
BROADCAST_IDS = 500_000
# Near duplicates: five-word shingles, Jaccard 80/100 or more.
NEAR = {"shingle": 5, "numerator": 80, "denominator": 100}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the labels of these
    documents, scores at its threshold or above go."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    # The scorer carries the id column as it is: here the whole row.
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc_id"), "text")
    return toxicity.score(rows, model).where(F.col("score") < toxicity.THRESHOLD).select("doc_id.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component stays."""
    found = jaccard_components(docs, **NEAR).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(broadcast_checked(written(found, "near_duplicates"), BROADCAST_IDS), "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every reported secret is replaced in the text; no document goes."""
    return redact_secrets(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text."""
    return encode_documents(docs, read_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", hide_secrets),
    ("sentencepiece", encode),
]

# A learned stage and a segmentation search: no SQL gives these rows. tests/llm
# holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
