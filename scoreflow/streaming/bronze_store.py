"""A bronze table whose files are compacted without losing or doubling a row.

``<root>/fresh/query=<id>/batch=<n>/event_date=<day>/`` holds what the stream
wrote: one folder per micro-batch, keyed by the query's id and batch number,
both kept by the checkpoint. A batch that is run again after a failure finds
its committed folder and leaves it, so a restart adds nothing.

``compact`` rewrites every day that new batches touched into few files of
bounded size, ``<root>/days/version=<v>/event_date=<day>/``, and commits a
manifest naming the live day folders and, per query, the last batch they
hold. Readers take the day folders of the last manifest and the batches after
it. Old folders go with ``vacuum``, after readers had time to move on.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scoreflow.sinks.manifest import (
    Manifest,
    child_folders,
    commit,
    drop_folder,
    exists,
    folder_bytes,
    read_manifest,
    read_text,
    unnamed,
)
from scoreflow.streaming.bronze import TRIGGER_INTERVAL, decode_envelope

DAY = "event_date"
FILE_BYTES = 256 << 20
# The decoded envelope, in order.
COLUMNS = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the checkpoint keeps for its query, across restarts."""
    return json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def _with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn(DAY, F.to_date("timestamp"))


def write_batch(rows: DataFrame, root: str, query: str, batch: int) -> None:
    """One micro-batch, once: a folder with its commit marker is left as it is,
    an unfinished one is written anew."""
    folder = f"{root}/fresh/query={query}/batch={batch}"
    if not exists(rows.sparkSession, f"{folder}/_SUCCESS"):
        _with_day(rows).write.mode("overwrite").partitionBy(DAY).parquet(folder)


def start_bronze_store(
    stream: DataFrame,
    root: str,
    checkpoint_location: str,
    processing_time: str | None = TRIGGER_INTERVAL,
    available_now: bool = False,
    query_name: str | None = None,
) -> StreamingQuery:
    """B5 into the store: decoded envelopes, one folder per micro-batch."""
    root = root.rstrip("/")

    def write(rows: DataFrame, batch: int) -> None:
        write_batch(rows, root, _query_id(rows.sparkSession, checkpoint_location), batch)

    writer = decode_envelope(stream).writeStream.outputMode("append").option("checkpointLocation", checkpoint_location)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.foreachBatch(write).start()


def _number(name: str, key: str) -> str:
    return name.removeprefix(f"{key}=")


def fresh_batches(spark: SparkSession, root: str, manifest: Manifest) -> dict[str, list[int]]:
    """Committed batches after those that the manifest's folders hold, by query."""
    found = {}
    for folder in child_folders(spark, f"{root}/fresh"):
        query = _number(folder, "query")
        after = manifest.state.get("through", {}).get(query, -1)
        numbers = sorted(int(_number(b, "batch")) for b in child_folders(spark, f"{root}/fresh/{folder}") if re.fullmatch(r"batch=\d+", b))
        done = [n for n in numbers if n > after and exists(spark, f"{root}/fresh/{folder}/batch={n}/_SUCCESS")]
        if done:
            found[query] = done
    return found


def _batch_folders(fresh: dict[str, list[int]]) -> list[str]:
    return [f"fresh/query={q}/batch={n}" for q, numbers in sorted(fresh.items()) for n in numbers]


def _day_folders(spark: SparkSession, root: str, batches: list[str]) -> dict[str, list[str]]:
    """Folders of each day in the batches."""
    out: dict[str, list[str]] = {}
    for batch in batches:
        for name in child_folders(spark, f"{root}/{batch}"):
            if name.startswith(f"{DAY}="):
                out.setdefault(_number(name, DAY), []).append(f"{batch}/{name}")
    return out


def _read(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], COLUMNS)
    return spark.read.schema(COLUMNS).parquet(*[f"{root}/{f}" for f in folders])


def read_bronze_store(spark: SparkSession, root: str, days: list[str] | None = None) -> DataFrame:
    """All rows, or those of some days (ISO dates) read from their folders alone."""
    root = root.rstrip("/")
    manifest = read_manifest(spark, root)
    live = _day_folders(spark, root, _batch_folders(fresh_batches(spark, root, manifest)))
    for day, folder in manifest.folders.items():
        live.setdefault(day, []).append(folder)
    return _read(spark, root, [f for day, folders in sorted(live.items()) if days is None or day in days for f in folders])


def compact(spark: SparkSession, root: str, file_bytes: int = FILE_BYTES) -> Manifest:
    """Rewrites the days of new batches. A day has at most one file more than
    its bytes need; days without new rows keep their folders. All days are one
    job, in which a day is dealt over as many tasks as it gets files."""
    root = root.rstrip("/")
    base = read_manifest(spark, root)
    fresh = fresh_batches(spark, root, base)
    if not fresh:
        return base
    touched = _day_folders(spark, root, _batch_folders(fresh))
    folders, files = [], []
    for day, parts in sorted(touched.items()):
        own = [*parts, *([base.folders[day]] if day in base.folders else [])]
        size = sum(folder_bytes(spark, f"{root}/{f}") for f in own)
        folders += own
        files.append((None if day.startswith("__") else day, max(1, -(-size // file_bytes))))
    version = base.version + 1
    target = f"days/version={version}-{spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()[:8]}"
    if folders:
        # One row per touched day: its files' numbers follow those of the days before.
        first, dealt = 0, []
        for day, n in files:
            dealt.append((day, n, first))
            first += n
        plan = spark.createDataFrame(dealt, "day string, n int, first int").select(F.col("day").cast("date").alias("day"), "n", "first")
        rows = _with_day(_read(spark, root, folders)).join(F.broadcast(plan), F.col(DAY).eqNullSafe(F.col("day")))
        number = F.col("first") + F.pmod(F.xxhash64("topic", "partition", "offset", "key", "value"), F.col("n")).cast("int")
        placed = rows.withColumn("file", number).repartitionById(first, "file").sortWithinPartitions("timestamp", "topic", "partition", "offset")
        placed.drop("day", "n", "first", "file").write.partitionBy(DAY).parquet(f"{root}/{target}")
    live = dict(base.folders) | {day: f"{target}/{DAY}={day}" for day in touched}
    through = dict(base.state.get("through", {})) | {q: numbers[-1] for q, numbers in fresh.items()}
    return commit(spark, root, base, live, {"through": through})


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Removes day folders that none of the last ``keep`` manifests names and
    batches that the oldest of those holds already. Returns what went."""
    root = root.rstrip("/")
    last = read_manifest(spark, root)
    if last.version < 0:
        return []
    versions = [f"days/{v}" for v in child_folders(spark, f"{root}/days")]
    # A folder of a version still to come is being written.
    old = [v for v in versions if int(re.search(r"version=(\d+)", v)[1]) <= last.version]
    days = [f"{v}/{d}" for v in old for d in child_folders(spark, f"{root}/{v}")]
    gone = unnamed(spark, root, days, keep)
    oldest = read_manifest(spark, root, max(0, last.version - max(1, keep) + 1))
    for query, through in oldest.state.get("through", {}).items():
        for name in child_folders(spark, f"{root}/fresh/query={query}"):
            if int(_number(name, "batch")) <= through:
                gone.append(f"fresh/query={query}/{name}")
    for folder in gone:
        drop_folder(spark, f"{root}/{folder}")
    return gone
