"""The payments bronze stream.

Kafka topic → decode ``key`` / ``value`` to UTF-8 text, keep the rest of the
envelope → append to a bronze table, checkpointed, one micro-batch per
trigger interval, at most ``max_offsets_per_trigger`` offsets per batch.

The stream is stateless (no aggregation, no watermark), so every batch is a
narrow map over the new offsets, and exactly-once output comes from the
checkpoint plus the file sink's commit log. ``startingOffsets`` only applies
when the checkpoint is empty; a restart resumes from the checkpoint.

The Kafka connector jar is not on this machine's classpath, so tests feed the
same envelope from staged files (``envelope_file_source``); the plan after
the source is identical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# The reference's stream settings.
MAX_OFFSETS_PER_TRIGGER = 20_000
TRIGGER_INTERVAL = "1 second"

ENVELOPE_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
)
ENVELOPE_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp", "timestampType")


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER,
    security_protocol: str | None = None,
    sasl_mechanism: str | None = None,
    sasl_jaas_config: str | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Kafka source options. ``min_partitions`` splits large topic partitions
    into more Spark tasks per batch (a topic with few partitions would
    otherwise cap the batch's parallelism at its partition count)."""
    if starting_offsets not in ("earliest", "latest") and not starting_offsets.startswith("{"):
        raise ValueError("startingOffsets must be earliest, latest or a JSON offset map")
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": str(int(max_offsets_per_trigger)),
        "failOnDataLoss": "true",
    }
    if security_protocol:
        opts["kafka.security.protocol"] = security_protocol
    if sasl_mechanism:
        opts["kafka.sasl.mechanism"] = sasl_mechanism
    if sasl_jaas_config:
        opts["kafka.sasl.jaas.config"] = sasl_jaas_config
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    return opts


def kafka_source(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The Kafka envelope as a streaming frame."""
    return spark.readStream.format("kafka").options(**options).load()


def envelope_file_source(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    fmt: str = "parquet",
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """The same envelope from files landing in ``path``, rate-limited by the
    bytes or by the number of files of a batch. With bytes a batch takes one
    amount of work however large or small the files are."""
    if (max_files_per_trigger is None) == (max_bytes_per_trigger is None):
        raise ValueError("a file stream needs a limit of files or of bytes per batch")
    reader = spark.readStream.format(fmt).schema(ENVELOPE_SCHEMA)
    if max_bytes_per_trigger is not None:
        return reader.option("maxBytesPerTrigger", str(int(max_bytes_per_trigger))).load(path)
    return reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger))).load(path)


def decode_envelope(stream: DataFrame) -> DataFrame:
    """``key`` and ``value`` bytes → text; envelope columns kept."""
    return stream.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        *[F.col(f"`{c}`") for c in ENVELOPE_COLUMNS[2:]],
    )


def start_bronze(
    stream: DataFrame,
    target: str,
    checkpoint_location: str,
    fmt: str = "parquet",
    processing_time: str | None = TRIGGER_INTERVAL,
    available_now: bool = False,
    query_name: str | None = None,
) -> StreamingQuery:
    """K5: append to ``target`` — a path (file sink) or a catalog table name
    (``toTable``). ``available_now`` processes what is there, in
    rate-limited batches, then stops (tests, backfills)."""
    writer = (
        decode_envelope(stream)
        .writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint_location)
    )
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    if "/" in target or ":" in target:
        return writer.start(target)
    return writer.toTable(target)
